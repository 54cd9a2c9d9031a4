"""URL rules against plain Python, with odd URLs, repeated rows and any extra columns."""

import random

from pyspark.sql import functions as F

from tallycast.llm import queries, urls

URLS = [
    None, "", "no scheme", "http://", "http://example.org", "http://Example.ORG/es/a", "https://a.b.example.org/en/12?x=1#y",
    "http://example.org/en/2", "ftp://x.com/fr/", "http://x.com/de/1", "http://com/fr/x", "a://b://c.org/p", "http://org/", "http://xorg/",
    "http://example.org/es", "http://é.org/ß?ü=1", "http://a.example.org?q=/es/", "http://x.com/" + "long/" * 4000, "://.org/",
]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule_of(host, path):
    fits = [
        (len(h + p), h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and host and path.startswith(p)
    ]
    return max(fits, default=(0, None, None))[1:]


def test_rules_against_plain_python(spark):
    rnd = random.Random(4)
    many = URLS + [rnd.choice(URLS) for _ in range(40)] + [
        f"http://{rnd.choice(['', 'www.', 'a.b.'])}{rnd.choice(['example.org', 'x.com', 'net'])}/{rnd.choice(['es', 'en', 'fr', 'de'])}/{i}" for i in range(60)
    ]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(many)], "page_id long, url string")
    for c in ("host", "path", "rule", "tokens", "rhost", "u", "label"):
        pages = pages.withColumn(c, F.lit("clash"))
    rules = spark.createDataFrame(list(queries.URL_RULES), "host string, path string, verdict string")
    got = urls.rule_verdicts(urls.with_parts(pages), rules).collect()
    assert len(got) == len(many)
    for r in got:
        host, path = parts(many[r.page_id])
        assert (r.host, r.path) == (host, path), many[r.page_id][:60]
        assert (r.rule, r.rule_verdict) == rule_of(host, path), many[r.page_id][:60]


def test_mined_rules_against_plain_counts(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(400):
        tokens = sorted({rnd.choice(["p:a", "p:b", "h:x", "h:y", "q:z"]) for _ in range(3)})
        rows.append((tokens, "block" if "p:a" in tokens and "h:x" in tokens else "allow"))
    mined = urls.mine(spark.createDataFrame(rows, "tokens array<string>, label string"), 0.05, 0.8).collect()
    assert any(r.antecedent == ["h:x", "p:a"] and r.label == "block" for r in mined)
    for r in mined:
        hold = [label for t, label in rows if set(r.antecedent) <= set(t)]
        both = sum(label == r.label for label in hold)
        assert abs(r.confidence - both / len(hold)) < 1e-9 and both / len(hold) >= 0.8 - 1e-9
        assert abs(r.support - both / len(rows)) < 1e-9 and both / len(rows) >= 0.05 - 1e-9
    # a token set gets the rule of the highest confidence, then support, then longest, then smallest text
    asked = [["h:x", "p:a"], ["q:z"], ["none"], []]
    out = urls.match(spark.createDataFrame([(t,) for t in asked], "tokens array<string>"), urls.mine(
        spark.createDataFrame(rows, "tokens array<string>, label string"), 0.05, 0.8)).collect()
    for r in out:
        fit = [m for m in mined if set(m.antecedent) <= set(r.tokens)]
        best = min(fit, key=lambda m: (-m.confidence, -m.support, -len(m.antecedent), " ".join(m.antecedent)), default=None)
        assert r.mined_verdict == (best.label if best else "allow")
