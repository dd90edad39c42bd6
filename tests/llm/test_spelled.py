"""Disguises with single spelled digits and with domains of all countries."""

import pytest

from siltbed.llm import pii


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("at one two seven dot zero dot zero dot one now", "ip", "one two seven dot zero dot zero dot one"),
        ("host 192 dot 168 dot one dot one up", "ip", "192 dot 168 dot one dot one"),
        ("host 10.0.zero.7 up", "ip", "10.0.zero.7"),
        ("host eight dot eight dot eight dot eight up", "ip", "eight dot eight dot eight dot eight"),
        ("ring +49 30 12 three 45 67 today", "phone", "+49 30 12 three 45 67"),
        ("card 4111 1111 one111 1111", None, None),
        ("card 4111 one 111 1111 1111", "card", "4111 one 111 1111 1111"),
        *[(f"mail jane at firma dot {e} please", "email", f"jane at firma dot {e}") for e in "nl jp ca au ru pl se xyz shop".split()],
    ],
)
def test_single_words(text, kind, found):
    want = [(kind, found, True)] if kind else []
    assert [(s["kind"], text[s["start"] : s["end"]], s["added"]) for s in pii.spans_of(text)] == want


@pytest.mark.parametrize("text", ["one of 3 in a row", "at one point seven people came", "4 or five, 6 or seven", "we met at noon, two dot com firms"])
def test_plain_digit_words(text):
    assert pii.spans_of(text) == []


def test_spelled_runs_are_linear():
    for text in ("one " * 80_000, "1 one " * 50_000, "one dot " * 40_000, "1" + " two" * 80_000, "one two" + " three" * 60_000):
        pii.spans_of(text)
