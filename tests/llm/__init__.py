"""Tests of the training-data operators; a package, so that module names may repeat those of the tests above."""
