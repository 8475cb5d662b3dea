"""Sources, projections, filters, scalar functions, feature preparation, splits."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions import scalars, subscribers
from ebbtide.operators import prepare, profile, scaling, splitting
from ebbtide.plans.features import feature_stages
from ebbtide.plans.snapshot import SERVICE_FLAGS, with_services
from ebbtide.plans.snapshot import snapshots
from ebbtide.queries.base import (
    CATEGORICAL,
    NUMERIC,
    N,
    R,
    cleaned,
    featured,
    query,
    rounded,
    scored,
    snap,
    typed,
)
from ebbtide.schema import SNAPSHOTS, column_roles
from ebbtide.session import fresh_path
from ebbtide.sources.tables import quarantine, read_checked, read_customers, table
from ebbtide.sources.writers import to_json_rows, write_table

# --- sources ---------------------------------------------------------------------------------


@query("src_01_parquet_scan", "select c_custkey, c_nationkey, c_acctbal, c_mktsegment from customer")
def _(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("src_01_csv_scan", "select * from snap")
def _(spark, d):
    df = snap(spark, d)
    path = fresh_path(spark, "snapshots-csv")
    write_table(df, path, "csv")
    return read_customers(spark, path, schema=df.schema)


@query(
    "src_01_malformed_records",
    """select reason, count(*) n_records, sum(c_custkey)::bigint keys from (
    select c_custkey, unnest(case c_custkey % 50 when 1 then ['unreadable: balance'] when 2 then ['short line'] when 3 then ['long line']
      when 4 then ['unreadable: nation', 'unreadable: balance'] else ['sound'] end) reason from customer) group by reason""",
)
def _(spark, d):
    """Lines of which some have bad numbers, too few or too many fields: every record is sound or set apart with its reasons."""
    kind = F.col("c_custkey") % 50
    balance = F.when(kind.isin(1, 4), "n/a").otherwise(F.col("c_acctbal").cast("string"))
    nation = F.when(kind == 4, "?").otherwise(F.col("c_nationkey").cast("string"))
    name = F.concat(F.lit('"'), "c_name", F.lit(', Ltd"'))
    more = F.when(kind == 2, "").when(kind == 3, F.concat(F.lit(","), balance, F.lit(",more"))).otherwise(F.concat(F.lit(","), balance))
    path = fresh_path(spark, "lines")
    table(spark, d, "customer").select(F.concat(F.col("c_custkey").cast("string"), F.lit(","), name, F.lit(","), nation, more)).write.text(path)
    checked = read_checked(spark, path, T.StructType.fromDDL("key long, name string, nation int, balance double"), header=False)
    sound, bad = quarantine(checked, fresh_path(spark, "checked"))
    rows = sound.select("key", F.lit("sound").alias("reason")).union(bad.select("key", F.explode("_reasons")))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n_records"), F.sum("key").alias("keys"))


# --- projections -----------------------------------------------------------------------------


@query("prj_01_select", "select customer_id, tenure, churn from snap")
def _(spark, d):
    return snapshots(spark, d).select("customer_id", "tenure", "churn")  # derived here, not read back


@query("prj_02_drop_key", "select * exclude (customer_id, churn) from snap")
def _(spark, d):
    return prepare.without_key(snap(spark, d), SNAPSHOTS, target=True)


@query("prj_03_features", f"select * exclude (churn) replace ({R('total_charges')} as total_charges, {R('monthly_charges')} as monthly_charges) from cleaned")
def _(spark, d):
    return rounded(prepare.split_features_target(cleaned(spark, d), SNAPSHOTS)[0])


@query("prj_03_target", "select customer_id, churn from cleaned")
def _(spark, d):
    return prepare.split_features_target(cleaned(spark, d), SNAPSHOTS)[1]


@query("prj_04_total_to_double", "select customer_id, total_charges from typed")
def _(spark, d):
    return typed(spark, d).select("customer_id", "total_charges")


@query("prj_05_senior_to_text", "select customer_id, senior_citizen from typed")
def _(spark, d):
    return typed(spark, d).select("customer_id", "senior_citizen")


@query("prj_06_label", "select customer_id, churn from typed")
def _(spark, d):
    return typed(spark, d).select("customer_id", "churn")


@query(
    "prj_07_column_roles",
    """select column_name as "column", case when column_type in ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'FLOAT', 'DOUBLE')
    then 'numerical' when column_type = 'VARCHAR' then 'categorical' else 'other' end as role
  from (select * from (describe orders) union all select * from (describe customer))""",
)
def _(spark, d):
    return column_roles(table(spark, d, "orders")).union(column_roles(table(spark, d, "customer")))


@query("prj_08_derived", f"select customer_id, {R('avg_monthly_charges')} avg_monthly_charges, tenure_group, contract_payment, internet_streaming from featured")
def _(spark, d):
    return rounded(
        featured(spark, d).select("customer_id", "avg_monthly_charges", "tenure_group", "contract_payment", "internet_streaming")
    )


@query("prj_09_prediction_label", "select customer_id, prediction, prediction_label from scored")
def _(spark, d):
    return scored(spark, d).select("customer_id", "prediction", "prediction_label")


@query(
    "prj_10_risk_level",
    """select customer_id, case when churn_probability >= 0.7 then 'High' when churn_probability >= 0.4 then 'Medium'
    else 'Low' end risk_level from scored""",
)
def _(spark, d):
    p = subscribers.risk_level(F.col("churn_probability"))
    return scored(spark, d).select("customer_id", p.alias("risk_level"))


# --- filters ---------------------------------------------------------------------------------


@query("flt_01_outliers", "select customer_id, tenure from snap where tenure > 60")
def _(spark, d):
    return prepare.outliers(snap(spark, d), "tenure", 60).select("customer_id", "tenure")


@query("flt_02_without_outliers", f"select {N('count(*)')} rows_before, {N('count(*) filter (tenure < 60)')} rows_after from snap")
def _(spark, d):
    return prepare.outlier_counts(snap(spark, d), "tenure", 60)


@query("flt_02_kept_rows", "select customer_id, tenure from snap where tenure < 60")
def _(spark, d):
    return prepare.without_outliers(snap(spark, d), "tenure", 60).select("customer_id", "tenure")


@query("flt_03_is_null", "select customer_id from typed where total_charges is null")
def _(spark, d):
    df = typed(spark, d)
    return df.where(scalars.is_missing(df, "total_charges")).select("customer_id")


@query("flt_04_complete_rows", f"select {N('count(total_charges)')} kept_rows, {N('count(*) - count(total_charges)')} dropped_rows from typed")
def _(spark, d):
    return prepare.dropped_count(typed(spark, d), NUMERIC)


@query("flt_04_complete_row_ids", "select customer_id from typed where total_charges is not null and tenure is not null and monthly_charges is not null")
def _(spark, d):
    return prepare.complete_rows(typed(spark, d), NUMERIC).select("customer_id")


@query("flt_05_high_confidence", f"select customer_id, {R('churn_probability')} churn_probability from scored where greatest(churn_probability, 1 - churn_probability) > 0.8")
def _(spark, d):
    probs = F.array(1 - F.col("churn_probability"), F.col("churn_probability"))
    return rounded(scored(spark, d).where(scalars.high_confidence(probs)).select("customer_id", "churn_probability"))


@query("flt_06_high_risk", f"select customer_id, {R('churn_probability')} churn_probability from scored where churn_probability >= 0.7")
def _(spark, d):
    high = subscribers.risk_level(F.col("churn_probability")) == "High"
    return rounded(scored(spark, d).where(high).select("customer_id", "churn_probability"))


# --- scalar functions ------------------------------------------------------------------------


@query("scl_01_fill_total", f"select customer_id, {R('total_charges')} total_charges from cleaned")
def _(spark, d):
    return rounded(cleaned(spark, d).select("customer_id", "total_charges"))


@query("scl_02_avg_monthly", f"select customer_id, {R('avg_monthly_charges')} avg_monthly_charges from featured")
def _(spark, d):
    return rounded(featured(spark, d).select("customer_id", "avg_monthly_charges"))


@query("scl_03_tenure_group", f"select tenure_group, {N('count(*)')} n from featured group by tenure_group")
def _(spark, d):
    return profile.group_counts(featured(spark, d), ["tenure_group"])


@query(
    "scl_04_charges_group",
    f""", cuts as (select quantile_cont(monthly_charges, 0.25) a, quantile_cont(monthly_charges, 0.5) b,
    quantile_cont(monthly_charges, 0.75) c from snap)
  select customer_id, case when monthly_charges <= a then 'Low' when monthly_charges <= b then 'Medium'
    when monthly_charges <= c then 'High' else 'Very High' end charges_group from snap, cuts""",
)
def _(spark, d):
    return prepare.add_charges_group(snap(spark, d), SNAPSHOTS).select("customer_id", "charges_group")


@query(
    "scl_05_service_count",
    """select customer_id, cast(coalesce(cast(fa as int) + cast(fn as int) + cast(fr as int) + cast(so as int)
    + cast(sf as int), 0) as int) service_count from snap left join lines on customer_id = l_orderkey""",
)
def _(spark, d):
    flags = [F.col(c) for c in SERVICE_FLAGS]
    return with_services(spark, d).select("customer_id", subscribers.service_count(flags).alias("service_count"))


@query("scl_06_interactions", f"select contract_payment, internet_streaming, {N('count(*)')} n from featured group by 1, 2")
def _(spark, d):
    return profile.group_counts(featured(spark, d), ["contract_payment", "internet_streaming"])


@query(
    "scl_07_finite",
    f"select customer_id, {R('case when tenure = 0 and monthly_charges > 250 then 1e6 when tenure = 0 then 0 else ln(tenure) end')} ratio from snap",
)
def _(spark, d):
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    raw = F.when(F.col("tenure") > 0, F.log("tenure")).when(F.col("monthly_charges") > 250, inf).otherwise(nan)
    return rounded(snap(spark, d).select("customer_id", scalars.finite(raw).alias("ratio")))


@query("scl_08_vector_element", f"select customer_id, {R('churn_probability')} p from scored")
def _(spark, d):
    vector = array_to_vector(F.array(1 - F.col("churn_probability"), F.col("churn_probability")))
    return rounded(scored(spark, d).select("customer_id", F.get(vector_to_array(vector), F.lit(1)).alias("p")))


@query("scl_09_confidence", f"select customer_id, {R('confidence_score')} confidence_score from scored")
def _(spark, d):
    return rounded(scored(spark, d).select("customer_id", "confidence_score"))


@query("scl_13_json", """select '{"customer_id":' || customer_id || ',"contract":"' || contract || '","tenure":' || tenure || '}' json from snap""")
def _(spark, d):
    return to_json_rows(snap(spark, d).select("customer_id", "contract", "tenure"))


# --- feature preparation ---------------------------------------------------------------------


@query("fea_01_mean_imputer", f"select customer_id, {R('coalesce(total_charges, (select avg(total_charges) from typed))')} total_charges from typed")
def _(spark, d):
    return rounded(prepare.impute(typed(spark, d), ["total_charges"], "mean").select("customer_id", "total_charges"))


@query("fea_02_median_imputer", f"select customer_id, {R('coalesce(total_charges, (select median(total_charges) from typed))')} total_charges from typed")
def _(spark, d):
    return rounded(prepare.impute(typed(spark, d), ["total_charges"], "median").select("customer_id", "total_charges"))


@query("fea_03_domain_imputer", f"select customer_id, {R('tenure * monthly_charges')} total_charges from typed where total_charges is null")
def _(spark, d):
    gaps = typed(spark, d).where(F.col("total_charges").isNull())
    return rounded(prepare.clean(gaps, SNAPSHOTS).select("customer_id", "total_charges"))


_INDEXED = list(CATEGORICAL)


def _sql_index(order: str) -> str:
    return (
        ", counts as ("
        + " union all ".join(f"select '{c}' col, {c} val, count(*) n from typed group by {c}" for c in _INDEXED)
        + f"), idx as (select *, cast(row_number() over (partition by col order by {order}) - 1 as double) i from counts)"
    )


_JOINED = "typed " + " ".join(f"join idx {c}_i on {c}_i.col = '{c}' and {c}_i.val = typed.{c}" for c in _INDEXED)


def _indexed(df, order="frequencyDesc", invalid="keep", fit_on=None):
    names = [f"{c}_index" for c in _INDEXED]
    indexer = StringIndexer(inputCols=_INDEXED, outputCols=names, stringOrderType=order, handleInvalid=invalid)
    return indexer.fit(fit_on if fit_on is not None else df).transform(df), names


@query("fea_04_string_index_keep", _sql_index("n desc, val") + " select customer_id, " + ", ".join(f"{c}_i.i {c}_index" for c in _INDEXED) + " from " + _JOINED)
def _(spark, d):
    df, names = _indexed(typed(spark, d).select("customer_id", *_INDEXED))
    return df.select("customer_id", *names)


@query("fea_05_string_index_error", _sql_index("n desc, val") + " select customer_id, " + ", ".join(f"{c}_i.i {c}_index" for c in _INDEXED) + " from " + _JOINED)
def _(spark, d):
    df, names = _indexed(typed(spark, d).select("customer_id", *_INDEXED), invalid="error")
    return df.select("customer_id", *names)


@query(
    "fea_06_one_hot",
    _sql_index("n desc, val")
    + " select customer_id, "
    + ", ".join(f"cast(contract_i.i = {i} as double) contract_{i}" for i in range(5))
    + " from "
    + _JOINED,
)
def _(spark, d):
    df, _names = _indexed(typed(spark, d).select("customer_id", *_INDEXED))
    encoder = OneHotEncoder(inputCols=["contract_index"], outputCols=["contract_hot"]).fit(df)
    slots = vector_to_array("contract_hot")
    hot = encoder.transform(df).select("customer_id", slots.alias("a"))
    return hot.select("customer_id", *[F.get("a", F.lit(i)).alias(f"contract_{i}") for i in range(5)])


@query("fea_07_label_encoding", _sql_index("val") + " select customer_id, " + ", ".join(f"{c}_i.i {c}_index" for c in _INDEXED) + " from " + _JOINED)
def _(spark, d):
    df, names = _indexed(typed(spark, d).select("customer_id", *_INDEXED), order="alphabetAsc")
    return df.select("customer_id", *names)


@query("fea_08_assemble", f"select customer_id, cast(tenure as double) v0, {R('monthly_charges')} v1, {R('total_charges')} v2 from typed where total_charges is not null")
def _(spark, d):
    assembler = VectorAssembler(inputCols=NUMERIC, outputCol="v", handleInvalid="skip")
    out = assembler.transform(typed(spark, d)).select("customer_id", vector_to_array("v").alias("a"))
    return rounded(out.select("customer_id", *[F.get("a", F.lit(i)).alias(f"v{i}") for i in range(3)]))


def _sql_scaled(expr, source="cleaned"):
    return ", ".join(f"{R(expr.format(c=c, s=source))} {c}_scaled" for c in NUMERIC)


@query("fea_09_standard_scaling", ", st as (select " + ", ".join(f"avg({c}) {c}_a, stddev_samp({c}) {c}_d" for c in NUMERIC) + " from cleaned) select customer_id, " + _sql_scaled("({c} - {c}_a) / {c}_d") + " from cleaned, st")
def _(spark, d):
    out = scaling.scale(cleaned(spark, d), NUMERIC, "standard")
    return rounded(out.select("customer_id", *[f"{c}_scaled" for c in NUMERIC]))


@query("fea_09_vector_scaling", ", st as (select " + ", ".join(f"avg({c}) {c}_a, stddev_samp({c}) {c}_d" for c in NUMERIC) + " from cleaned) select customer_id, " + _sql_scaled("({c} - {c}_a) / {c}_d") + " from cleaned, st")
def _(spark, d):
    assembled = VectorAssembler(inputCols=NUMERIC, outputCol="v").transform(cleaned(spark, d).select("customer_id", *NUMERIC))
    scaler = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(assembled)
    out = scaler.transform(assembled).select("customer_id", vector_to_array("s").alias("a"))
    return rounded(out.select("customer_id", *[F.get("a", F.lit(i)).alias(f"{c}_scaled") for i, c in enumerate(NUMERIC)]))


@query("fea_10_minmax_scaling", ", st as (select " + ", ".join(f"min({c}) {c}_a, max({c}) - min({c}) {c}_d" for c in NUMERIC) + " from cleaned) select customer_id, " + _sql_scaled("({c} - {c}_a) / {c}_d") + " from cleaned, st")
def _(spark, d):
    out = scaling.scale(cleaned(spark, d), NUMERIC, "minmax")
    return rounded(out.select("customer_id", *[f"{c}_scaled" for c in NUMERIC]))


@query("fea_11_robust_scaling", ", st as (select " + ", ".join(f"median({c}) {c}_a, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) {c}_d" for c in NUMERIC) + " from cleaned) select customer_id, " + _sql_scaled("({c} - {c}_a) / {c}_d") + " from cleaned, st")
def _(spark, d):
    out = scaling.scale(cleaned(spark, d), NUMERIC, "robust")
    return rounded(out.select("customer_id", *[f"{c}_scaled" for c in NUMERIC]))


@query(
    "fea_15_new_categories",
    """, known as (select distinct region from snap where region < 'EUROPE'), k as (select count(*) n from known)
  select region, cast(region in (select region from known) as boolean) known, cast(count(*) as bigint) n
  from snap group by region""",
)
def _(spark, d):
    df = typed(spark, d).select("customer_id", *_INDEXED)
    known = df.where(F.col("region") < "EUROPE")
    out, _names = _indexed(df, fit_on=known)
    labels = known.agg(F.count_distinct("region")).scalar()
    return out.groupBy("region", (F.col("region_index") < labels).alias("known")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "fea_16_class_weights",
    f"""select churn, {R('(select count(*) from cleaned) * 1.0 / ((select count(distinct churn) from cleaned) * count(*))')} weight,
    {N('count(*)')} n from cleaned group by churn""",
)
def _(spark, d):
    weighted = splitting.class_weights(cleaned(spark, d), "churn")
    return rounded(weighted.groupBy("churn").agg(F.max("weight").alias("weight"), F.count(F.lit(1)).alias("n")))


@query(
    "fea_06_one_hot_drop_first",
    _sql_index("val")
    + " select customer_id, "
    + ", ".join(f"cast(contract_i.i = {i} as double) contract_{i}" for i in range(1, 5))
    + " from "
    + _JOINED,
)
def _(spark, d):
    df = snap(spark, d).select("customer_id", "contract")
    stages = feature_stages([], ["contract"], encoding="onehot_drop_first", scaling=None)
    out = Pipeline(stages=stages).fit(df).transform(df).select("customer_id", vector_to_array("features").alias("a"))
    return out.select("customer_id", *[F.get("a", F.lit(i - 1)).alias(f"contract_{i}") for i in range(1, 5)])


# --- splits and samples ----------------------------------------------------------------------

_HASH = "cast('0x' || substr(md5(customer_id || '-{seed}'), 1, 8) as bigint)"


@query("mod_01_hash_split", f"select customer_id, case when {_HASH.format(seed=42)} / 4294967296.0 < 0.8 then 'train' else 'test' end split from snap")
def _(spark, d):
    return splitting.with_split(snap(spark, d), "customer_id", 0.8, 42).select("customer_id", "split")


@query(
    "mod_02_stratified_split",
    f"""select customer_id, churn, case when row_number() over (partition by churn order by {_HASH.format(seed=42)}, customer_id)
    <= floor(count(*) over (partition by churn) * cast(0.2 as double) + 0.5) then 'test' else 'train' end split from cleaned""",
)
def _(spark, d):
    out = splitting.stratified_split(cleaned(spark, d), "customer_id", "churn", 0.2, 42)
    return out.select("customer_id", "churn", "split")


@query("mod_08_folds", f"select cast({_HASH.format(seed=42)} % 3 as int) fold, {N('count(*)')} n from snap group by 1")
def _(spark, d):
    return profile.group_counts(splitting.with_fold(snap(spark, d), "customer_id"), ["fold"])


@query("srt_04_random_rows", f"select customer_id, contract, tenure from snap order by {_HASH.format(seed=42)}, customer_id limit 10")
def _(spark, d):
    return prepare.random_rows(snap(spark, d), "customer_id", 10, 42).select("customer_id", "contract", "tenure")


@query("srt_05_latest_rows", "select customer_id, contract, tenure from snap order by customer_id desc limit 100")
def _(spark, d):
    return prepare.latest_rows(snap(spark, d), "customer_id", 100).select("customer_id", "contract", "tenure")


