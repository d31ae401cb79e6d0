from dataclasses import replace

import pytest

from catalogue.inputs import ACCOUNT
from tallyframe import CARD, Band, Rule


def test_the_card_contract_is_the_closed_set_of_25_integers():
    assert len(CARD.columns) == len(CARD.integers) == 25
    assert [s.month for s in CARD.slots][0::5] == ["2005-09-01", "2005-04-01"]
    assert len(CARD.rules) == 22


def test_text_columns_are_not_integers():
    assert set(ACCOUNT.columns) - set(ACCOUNT.integers) == {"segment"}
    assert ACCOUNT.money("bill") == "bill_cents"


@pytest.mark.parametrize("change, message", [
    ({"columns": (*CARD.columns, "ID")}, "repeated"),
    ({"columns": (*CARD.columns, "copies")}, "reserved"),
    ({"id": "account"}, "unknown"),
    ({"rules": (*CARD.rules, Rule("invalid_outcome", "true"))}, "repeated"),
    ({"bands": (Band("all", None), Band("rest", 10))}, "last band"),
])
def test_a_contract_that_cannot_work_is_refused(change, message):
    with pytest.raises(ValueError, match=message):
        replace(CARD, **change)
