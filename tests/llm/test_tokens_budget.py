"""Budgets are met inside a piece, and totals come from the prefix table."""

from recsense.llm.tokens import Prefixes


def test_truncate_cuts_inside_a_long_piece():
    for text in ("qzxv" * 50, "some words " + "qzxv" * 50 + " end"):
        found = Prefixes(text)
        for budget in (1, 3, 7, 20):
            cut = found.truncate(budget)
            assert cut > 0 and found.at(cut) <= budget < found.at(cut + 1)
        assert found.truncate(0) == 0 and found.truncate(10**6) == len(text)
    assert Prefixes("").truncate(5) == 0


def test_total_is_the_last_entry_of_the_table():
    found = Prefixes("two words")
    found.totals
    found.counts.clear()
    assert found.total == found.totals[-1] > 0
