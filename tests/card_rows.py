"""Rows of the card contract, and rows of frames in a fixed order. Not a conftest: two folders have one."""

import re

from tallyframe.contract import CARD


def smallest(contract):
    """For each column the smallest whole number, from 0 on, that no rule of the contract objects to."""
    out = dict.fromkeys(contract.columns, 0)
    for rule in contract.rules:
        words = re.findall(r"-?\w+", rule.fails_when)
        if words[0] in out and "NOT" in words:
            out[words[0]] = max(0, int(words[3]))
        elif words[0] in out and "<=" in rule.fails_when:
            out[words[0]] = int(words[1]) + 1
    out[contract.limit] = contract.bands[0].below
    return {c: str(v) for c, v in out.items()}


VALID = smallest(CARD)


def card(**changes):
    """The smallest valid row of the card contract, with some fields changed."""
    return tuple((VALID | changes)[c] for c in CARD.columns)


def rows_of(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())
