"""Snapshot contracts.

A contract says what one raw snapshot looks like and what a good row is: the
closed set of columns, which of them are integers, the ordered rules a row may
break, the period slots stored side by side in a row, and the limit bands.
Every operator is generated from it, so a new source needs a new contract and
no new code.
"""

from __future__ import annotations

from dataclasses import dataclass

# Column that carries the text of a row with too many or too few fields.
MALFORMED = "malformed_text"

# Flags that the operators set before the rules are evaluated: an integer column
# is NULL, and another distinct row has the same id.
MISSING = "has_missing"
CONFLICT = "id_conflict"


# Columns that the operators add next to those of a contract.
RESERVED = {
    MALFORMED, MISSING, CONFLICT, "raw", "record_hash", "copies", "accepted",
    "rejection_reason", "source_sha256", "ingested_at", "run_id",
}


@dataclass(frozen=True)
class Rule:
    """A reason code and the SQL predicate over typed columns that raises it.

    A predicate that evaluates to NULL does not raise its code.
    """

    code: str
    fails_when: str


@dataclass(frozen=True)
class Slot:
    """One period held as three columns of the wide row."""

    month: str
    status: str
    bill: str
    payment: str


@dataclass(frozen=True)
class Band:
    """A limit band; ``below`` is its exclusive upper bound, None for the last."""

    name: str
    below: int | None


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[str, ...]
    text_columns: tuple[str, ...]
    id: str
    limit: str
    rules: tuple[Rule, ...]
    slots: tuple[Slot, ...]
    bands: tuple[Band, ...]
    unit: str
    delayed_from: int = 2
    undocumented: tuple[int, ...] = (-2, 0)

    def __post_init__(self):
        own = set(self.columns)
        used = {self.id, self.limit, *self.text_columns}
        used.update(*((s.status, s.bill, s.payment) for s in self.slots))
        if len(own) != len(self.columns) or len({r.code for r in self.rules}) != len(self.rules):
            raise ValueError(f"Contract {self.name}: a column or reason code is repeated")
        if used - own:
            raise ValueError(f"Contract {self.name}: unknown columns {sorted(used - own)}")
        if own & RESERVED:
            raise ValueError(f"Contract {self.name}: reserved columns {sorted(own & RESERVED)}")
        if [b.below for b in self.bands].index(None) != len(self.bands) - 1:
            raise ValueError(f"Contract {self.name}: only the last band is open")

    @property
    def integers(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if c not in self.text_columns)

    def money(self, measure: str) -> str:
        """Name of an amount column, e.g. ``bill`` in unit ``ntd`` -> ``bill_ntd``."""
        return f"{measure}_{self.unit}"


# A row with surplus fields fills every column, so it needs a code of its own. A
# row with too few fields has NULLs and is already named by the missing rule.
MISSING_RULE = Rule("missing_or_noninteger", MISSING)
MALFORMED_RULE = Rule("malformed_row", f"NOT {MISSING} AND {MALFORMED} IS NOT NULL")


def _card() -> Contract:
    # Column names, domains, reason codes and months of the card snapshot.
    status = ("PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6")
    months = ("2005-09-01", "2005-08-01", "2005-07-01", "2005-06-01", "2005-05-01", "2005-04-01")
    bills = tuple(f"BILL_AMT{n}" for n in range(1, 7))
    payments = tuple(f"PAY_AMT{n}" for n in range(1, 7))
    columns = (
        "ID", "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE",
        *status, *bills, *payments, "default_next_month",
    )
    return Contract(
        name="card",
        columns=columns,
        text_columns=(),
        id="ID",
        limit="LIMIT_BAL",
        rules=(
            MISSING_RULE,
            MALFORMED_RULE,
            Rule("invalid_account_id", "ID <= 0"),
            Rule("nonpositive_credit_limit", "LIMIT_BAL <= 0"),
            Rule("age_out_of_range", "AGE NOT BETWEEN 18 AND 120"),
            Rule("invalid_sex_code", "SEX NOT IN (1, 2)"),
            Rule("education_code_out_of_range", "EDUCATION NOT BETWEEN 0 AND 6"),
            Rule("marriage_code_out_of_range", "MARRIAGE NOT BETWEEN 0 AND 3"),
            Rule("invalid_outcome", "default_next_month NOT IN (0, 1)"),
            Rule("conflicting_account_id", CONFLICT),
            *(Rule(f"invalid_{c}", f"{c} NOT BETWEEN -2 AND 9") for c in status),
            *(Rule(f"negative_{c}", f"{c} < 0") for c in payments),
        ),
        slots=tuple(map(Slot, months, status, bills, payments)),
        bands=(
            Band("below_100k", 100_000),
            Band("100k_to_299k", 300_000),
            Band("300k_plus", None),
        ),
        unit="ntd",
    )


CARD = _card()
