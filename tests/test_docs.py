"""The README coverage table names every registered query, and every query has an oracle."""

import os
import re

import __spark_entry__ as E

README = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")


def test_every_query_is_documented_and_has_an_oracle():
    text = open(README, encoding="utf-8").read()
    documented = set(re.findall(r"`([a-z0-9_]+)`", text))
    keys = set(E.queries())
    assert keys - documented == set()
    optional = set(E.LLM_QUERIES)
    assert keys - optional == set(E.oracle_sql()) - optional
