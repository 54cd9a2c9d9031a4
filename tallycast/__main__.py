"""``python -m tallycast --units ... --daily ... --banded ... --population ... --out ...``"""

from tallycast.job import main

main()
