"""Aggregations, set operations and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.operators import profile, quality, sets
from ebbtide.plans.scoring import file_stats, score_stats
from ebbtide.queries.base import CATEGORICAL, NUMERIC, N, R, cleaned, featured, query, rounded, scored, snap, typed
from ebbtide.sources.tables import table

_COLUMNS = [
    "customer_id",
    "account_id",
    "internet_service",
    "region",
    "contract",
    "payment_method",
    "senior_citizen",
    "tenure",
    "monthly_charges",
    "total_charges",
    "churn",
    "snapshot_ts",
]


def _each(template: str, columns) -> str:
    return " union all ".join(template.format(c=c) for c in columns)


@query("agg_01_shape", f"select {N('count(*)')} n_rows, cast(12 as int) n_columns from snap")
def _(spark, d):
    return profile.shape(snap(spark, d))


@query("agg_02_frequencies", _each("select '{c}' \"column\", {c} \"value\", cast(count(*) as bigint) n from typed group by {c}", CATEGORICAL))
def _(spark, d):
    return profile.frequencies(typed(spark, d), CATEGORICAL)


@query(
    "agg_03_churn_by_contract",
    f"""select contract, tenure_group, {N('count(*)')} n, {N('sum(churn)')} churned, {R('avg(churn)')} churn_rate
  from featured group by contract, tenure_group""",
)
def churn_by_contract(spark, d):
    return rounded(profile.churn_rate_by(featured(spark, d), ["contract", "tenure_group"], "churn"))


@query(
    "agg_03_contract_churn_counts", f"select contract, churn, {N('count(*)')} n from snap group by contract, churn"
)
def _(spark, d):
    return profile.group_counts(snap(spark, d), ["contract", "churn"])


@query(
    "agg_03_churn_rollup",
    f"""select contract, tenure_group, {N('count(*)')} n, {N('sum(churn)')} churned, {R('avg(churn)')} churn_rate
  from featured group by rollup (contract, tenure_group)""",
)
def _(spark, d):
    return rounded(profile.churn_rate_by(featured(spark, d), ["contract", "tenure_group"], "churn", rollup=True))


@query("agg_04_missing_counts", _each("select '{c}' \"column\", cast(count(*) - count({c}) as bigint) n_missing, cast(count(*) as bigint) n_rows from typed", _COLUMNS))
def _(spark, d):
    return profile.missing_counts(typed(spark, d))


@query("agg_05_means", _each("select '{c}' \"column\", " + R("avg({c})") + " mean from typed", NUMERIC))
def _(spark, d):
    return rounded(profile.means(typed(spark, d), NUMERIC))


@query("agg_06_medians", _each("select '{c}' \"column\", " + R("median({c})") + " median from typed", NUMERIC))
def _(spark, d):
    return rounded(profile.medians(typed(spark, d), NUMERIC))


@query(
    "agg_07_describe",
    _each(
        "select '{c}' \"column\", cast(count({c}) as bigint) n, "
        + ", ".join(
            f"{R(e)} {n}"
            for e, n in [
                ("avg({c})", "mean"),
                ("stddev_samp({c})", "std"),
                ("min({c})", "min"),
                ("quantile_cont({c}, 0.25)", "p25"),
                ("quantile_cont({c}, 0.5)", "p50"),
                ("quantile_cont({c}, 0.75)", "p75"),
                ("max({c})", "max"),
            ]
        )
        + " from typed",
        NUMERIC,
    ),
)
def _(spark, d):
    return rounded(profile.describe(typed(spark, d), NUMERIC))


@query(
    "agg_08_correlations",
    " union all ".join(
        f"select '{a}' column_a, '{b}' column_b, {R(f'corr({a}, {b})')} corr from cleaned" for a in NUMERIC for b in NUMERIC
    ),
)
def _(spark, d):
    return rounded(profile.correlations(cleaned(spark, d), NUMERIC))


_HIST = (
    "select '{c}' \"column\", cast(least(floor(({c} - lo) / (hi - lo) * 20), 19) as int) bin, cast(count(*) as bigint) n "
    "from (select {c}, min({c}) over () lo, max({c}) over () hi from cleaned) group by 2"
)


@query("agg_09_histograms", _each(_HIST, NUMERIC))
def _(spark, d):
    return profile.histograms(cleaned(spark, d), NUMERIC, 20)


@query("agg_10_class_shares", f"select churn, {N('count(*)')} n, {R('count(*) * 1.0 / (select count(*) from snap)')} share from snap group by churn")
def _(spark, d):
    return rounded(profile.distribution(snap(spark, d), "churn", normalize=True))


@query("agg_11_class_counts", f"select churn, {N('count(*)')} n from snap group by churn")
def _(spark, d):
    return profile.distribution(snap(spark, d), "churn")


_ALL = """customer_id, account_id, internet_service, region, contract, payment_method, senior_citizen, tenure,
    monthly_charges, total_charges, churn, snapshot_ts"""


@query("agg_12_duplicates", f"select {N('sum(n - 1)')} duplicate_rows from (select count(*) n from snap group by {_ALL})")
def _(spark, d):
    return profile.duplicate_rows(snap(spark, d))


_FEW = ["region", "contract", "payment_method", "tenure"]


@query("agg_12_duplicate_profiles", f"select {N('sum(n - 1)')} duplicate_rows from (select count(*) n from snap group by {', '.join(_FEW)})")
def _(spark, d):
    return profile.duplicate_rows(snap(spark, d).select(*_FEW))


@query(
    "agg_12_duplicate_documents",
    f"select {N('sum(n - 1)')} duplicate_rows from (select count(*) n from documents group by text, lang, source, n_chars)",
)
def _(spark, d):
    return profile.duplicate_rows(table(spark, d, "documents").drop("doc_id"))


@query("agg_13_missing_cells", "select cast(count(*) - count(total_charges) as bigint) missing_cells from typed")
def _(spark, d):
    return profile.missing_cells(typed(spark, d))


@query(
    "agg_14_missing_ratios",
    _each(
        "select '{c}' \"column\", " + R("(count(*) - count({c})) * 1.0 / count(*)") + " missing_ratio, "
        "(count(*) - count({c})) * 1.0 / count(*) > 0.05 excessive from typed",
        _COLUMNS,
    ),
)
def _(spark, d):
    return rounded(profile.missing_ratios(typed(spark, d), above=0.05))


@query("agg_20_distinct", _each("select '{c}' \"column\", cast(count(distinct {c}) as bigint) n_distinct from typed", CATEGORICAL))
def _(spark, d):
    return profile.distinct_counts(typed(spark, d), CATEGORICAL)


_SUMMARY_STATS = {
    "mean": "avg({c})",
    "std": "stddev_samp({c})",
    "min": "min({c})",
    "p25": "quantile_cont({c}, 0.25)",
    "p50": "quantile_cont({c}, 0.5)",
    "p75": "quantile_cont({c}, 0.75)",
    "max": "max({c})",
}


@query(
    "agg_21_data_summary",
    _each("select '{c}' \"column\", 'rows' measure, cast(count(*) as double) \"value\" from typed", NUMERIC + CATEGORICAL)
    + " union all "
    + _each("select '{c}', 'missing', cast(count(*) - count({c}) as double) from typed", NUMERIC + CATEGORICAL)
    + " union all "
    + _each("select '{c}', 'distinct', cast(count(distinct {c}) as double) from typed", CATEGORICAL)
    + "".join(" union all " + _each(f"select '{{c}}', '{m}', {R(e)} from typed", NUMERIC) for m, e in _SUMMARY_STATS.items()),
)
def _(spark, d):
    return rounded(profile.data_summary(typed(spark, d), NUMERIC, CATEGORICAL))


# --- set operations --------------------------------------------------------------------------


@query("set_01_required_minus_actual", "select c_custkey account_id from customer except select account_id from snap")
def _(spark, d):
    required = table(spark, d, "customer").select(F.col("c_custkey").alias("account_id"))
    return sets.absent(required, snap(spark, d).select("account_id"))


@query("set_02_common_values", "select c_custkey as k from customer where c_acctbal < 0 intersect select o_custkey from orders where o_totalprice > 300000")
def _(spark, d):
    poor = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("k"))
    large = table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("k"))
    return sets.common(poor, large)


# --- data quality ----------------------------------------------------------------------------


@query(
    "dq_01_quality_report",
    """select 'total_rows' measure, cast(count(*) as bigint) "value" from typed union all select 'total_columns', 12
  union all select 'missing_values', count(*) - count(total_charges) from typed union all select 'duplicate_rows', 0
  union all select 'target=' || case churn when 1 then '1.0' else '0.0' end, count(*) from typed group by churn""",
)
def _(spark, d):
    return quality.quality_report(typed(spark, d), "churn")


@query(
    "dq_02_quality_rules",
    f""", t as (select cast(count(*) as double) n, cast(count(*) - count(total_charges) as double) m from typed)
  select 'enough_rows' rule, n observed, cast(1000 as double) "limit", n > 1000 passed from t
  union all select 'enough_columns', 12, 10, true union all select 'few_missing_values', m, {R('n * 0.1')}, m < n * 0.1 from t""",
)
def _(spark, d):
    return rounded(quality.quality_rules(typed(spark, d)))


_DOMAINS = {
    "internet_service": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"),
    "senior_citizen": ("0",),
    "contract": ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"),
    "payment_method": ("F", "O"),
    "region": ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
}


@query(
    "dq_04_domain_violations",
    " union all ".join(
        f"select '{c}' \"column\", {c} \"value\", {N('count(*)')} n from typed where {c} not in ({', '.join(repr(v) for v in vs)}) group by {c}"
        for c, vs in _DOMAINS.items()
    ),
)
def _(spark, d):
    return quality.domain_violations(typed(spark, d), _DOMAINS)


@query(
    "inf_06_validate_input",
    f""", t as (select cast(count(*) as double) n, count(*) filter (try_cast(total_charges as double) is null) u from snap)
  select 'missing_column' "check", 'issue' severity, 'payment_day' "column", cast(null as double) "value"
  union all select 'non_numeric', 'warning', 'total_charges', cast(u as double) from t where u > 0""",
)
def _(spark, d):
    return quality.validate_input(snap(spark, d), [*NUMERIC, "payment_day"], NUMERIC)


@query(
    "inf_06_missing_values",
    f"""select 'missing_values' "check", 'warning' severity, 'total_charges' "column",
    {R('count(*) filter (total_charges is null) * 1.0 / count(*)')} "value" from typed""",
)
def _(spark, d):
    return rounded(quality.validate_input(typed(spark, d), NUMERIC, NUMERIC, missing_limit=0.05))


@query(
    "agg_15_prediction_stats",
    f"""select {N('count(*)')} total_predictions, {N('sum(prediction)')} predicted_churn_count,
    {R('avg(prediction)')} predicted_churn_rate, {N('count(*) filter (confidence_score > 0.8)')} high_confidence_predictions
  from scored""",
)
def _(spark, d):
    return rounded(score_stats(scored(spark, d)))


@query(
    "agg_16_file_totals",
    f"""select {N('count(*)')} total_processed, {N('sum(prediction)')} total_churn_predicted, {R('avg(prediction)')} churn_rate
  from scored""",
)
def _(spark, d):
    return rounded(file_stats(scored(spark, d)).drop("dropped_rows"))
