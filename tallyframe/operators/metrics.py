"""Metric definitions.

Each metric is one SQL text over a relation, used twice: with a table name in
the permanent views, and with a DataFrame through the functions below. There
is no second definition that could drift. All of them combine before the
shuffle and produce one row per month or per month and band.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyframe.contract import CARD, Contract


def monthly_text(relation: str, contract: Contract = CARD) -> str:
    unit = contract.unit
    return f"""
        SELECT month, accounts, delayed_accounts, delayed_account_rate,
               positive_total AS positive_bill_{unit},
               delayed_total AS delayed_bill_{unit},
               if(positive_total > 0, delayed_total / positive_total, NULL) AS delayed_bill_share,
               payments_{unit}, undocumented_status_accounts
        FROM (
            SELECT month,
                   count(*) AS accounts,
                   count_if(delayed_2plus) AS delayed_accounts,
                   avg(if(delayed_2plus, 1D, 0D)) AS delayed_account_rate,
                   sum(positive_bill_{unit}) AS positive_total,
                   sum(if(delayed_2plus, positive_bill_{unit}, 0L)) AS delayed_total,
                   sum(payment_{unit}) AS payments_{unit},
                   count_if(status_not_documented) AS undocumented_status_accounts
            FROM {relation}
            GROUP BY month
        )"""


def segment_text(relation: str, contract: Contract = CARD) -> str:
    """``relation`` holds facts together with the limit band of their account."""
    unit = contract.unit
    return f"""
        SELECT month, limit_band,
               count(*) AS accounts,
               sum(positive_bill_{unit}) AS positive_bill_{unit},
               count_if(delayed_2plus) AS delayed_accounts,
               avg(if(delayed_2plus, 1D, 0D)) AS delayed_account_rate
        FROM {relation}
        GROUP BY month, limit_band"""


def alert_text(relation: str, threshold: str, per: tuple[str, ...] = ()) -> str:
    """Change against the previous row in time; ``threshold`` is a SQL scalar.

    The input is already aggregated to one row per month (and ``per`` columns),
    so the ordered window holds a handful of rows whatever the data size.
    """
    entity = "".join(f"{c}, " for c in per)
    scope = f"PARTITION BY {', '.join(per)} " if per else ""
    return f"""
        SELECT {entity}month, delayed_account_rate, previous_rate,
               change_percentage_points, threshold_percentage_points,
               CASE WHEN previous_rate IS NULL THEN 'BASELINE'
                    WHEN change_percentage_points >= threshold_percentage_points THEN 'REVIEW'
                    ELSE 'WITHIN_THRESHOLD' END AS alert_status
        FROM (
            SELECT {entity}month, delayed_account_rate, previous_rate,
                   100D * (delayed_account_rate - previous_rate) AS change_percentage_points,
                   CAST({threshold} AS DOUBLE) AS threshold_percentage_points
            FROM (
                SELECT {entity}month, delayed_account_rate,
                       lag(delayed_account_rate) OVER ({scope}ORDER BY month) AS previous_rate
                FROM {relation}
            )
        )"""


def monthly(facts: DataFrame, contract: Contract = CARD) -> DataFrame:
    """Accounts, delay rate, bills, payments and undocumented codes per month."""
    return facts.sparkSession.sql(monthly_text("{facts}", contract), facts=facts)


def segments(
    facts: DataFrame, dimension: DataFrame | None = None, contract: Contract = CARD, keys: tuple[str, ...] = ("account_id", "run_id")
) -> DataFrame:
    """Accounts, bills and delay rate per month and limit band.

    Facts built ``with_band`` need no dimension and no join. Others get the band
    by their account: an account has one fact per month (the grain check), so
    no key of that join is hot. Views of one publication need the account alone as
    ``keys``; their tables are bucketed by it, and the join moves no row.
    """
    if dimension is not None:
        facts = facts.join(dimension.select(*keys, "limit_band"), list(keys))
    return facts.sparkSession.sql(segment_text("{facts}", contract), facts=facts)


def alerts(
    rates: DataFrame, threshold_pp: float = 1.0, per: tuple[str, ...] = ()
) -> DataFrame:
    """BASELINE, REVIEW or WITHIN_THRESHOLD per month, optionally per entity."""
    text = alert_text("{rates}", ":threshold", per)
    return rates.sparkSession.sql(text, args={"threshold": float(threshold_pp)}, rates=rates)
