"""Customer-value metrics (Tier 2): RFM, key leaderboard, top-3 models, behaviour
clusters, tag pools and struct results (S-8, S-10, S-11, S-13, S-14, S-26).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import money4, round4
from ..operators.bucketed import BucketedTable, newest_per_key
from ..operators.percentile import global_percentiles, score_by_cutoffs
from ..operators.sequence import position_in_group
from ..session import freeze
from .metrics import MetricContext, in_range

QUINTILES = [0.2, 0.4, 0.6, 0.8]

# Fixed values (ours): RFM segment by the sum of the three 1..5 scores.
RFM_SEGMENTS = [(13, "champions"), (10, "loyal"), (7, "potential"), (5, "at_risk"), (0, "hibernating")]


def rfm_measures(fact: DataFrame, ctx: MetricContext) -> DataFrame:
    """Per account: days since last call, active days and usage spend over the range."""
    f = fact.filter(in_range(F.col("request_time"), ctx)).withColumn("_d", F.to_date("request_time"))
    per = f.groupBy("account_sk").agg(F.max("_d").alias("_last"),
                                      F.count_distinct("_d").alias("frequency_days"),
                                      money4(F.sum("revenue_usd")).alias("monetary_usd"))
    return per.select("account_sk", F.datediff(F.lit(ctx.end_date), F.col("_last")).alias("recency_days"),
                      F.col("frequency_days").cast("bigint").alias("frequency_days"), "monetary_usd")


def segment_of(total: Column) -> Column:
    expr = F.lit(RFM_SEGMENTS[-1][1])
    for floor, name in reversed(RFM_SEGMENTS[:-1]):
        expr = F.when(total >= floor, name).otherwise(expr)
    return expr


def _approx_cuts(df: DataFrame, col: str) -> list[float]:
    """Quintile cut-offs from one ``percentile_approx`` sketch (a single aggregate row)."""
    return [float(x) for x in df.agg(F.percentile_approx(F.col(col).cast("double"), QUINTILES, 10000)).first()[0]]


def rfm(fact: DataFrame, ctx: MetricContext, approximate: bool = False) -> DataFrame:
    """S-8: quintile scores of recency (lower is better), frequency and monetary, and a segment.

    The four cut-offs per measure are exact ``percentile_cont`` values over all
    accounts, found by a distributed rank (no global window, no single task
    holding every account); accounts sharing a value share a score.
    """
    m = freeze(rfm_measures(fact, ctx))  # one row per account, read by three rankings and the scoring
    m = m.withColumn("_money", F.col("monetary_usd").cast("double"))
    if approximate:  # one sketch per measure: for very large account sets
        r_cut, f_cut, m_cut = (_approx_cuts(m, c) for c in ("recency_days", "frequency_days", "_money"))
    else:
        r_cut = global_percentiles(m, "recency_days", ["account_sk"], QUINTILES)
        f_cut = global_percentiles(m, "frequency_days", ["account_sk"], QUINTILES)
        m_cut = global_percentiles(m, "_money", ["account_sk"], QUINTILES)
    scored = m.select(
        "account_sk", "recency_days", "frequency_days", "monetary_usd",
        score_by_cutoffs(F.col("recency_days"), r_cut, higher_is_better=False).alias("r_score"),
        score_by_cutoffs(F.col("frequency_days"), f_cut).alias("f_score"),
        score_by_cutoffs(F.col("_money"), m_cut).alias("m_score"))
    return scored.withColumn("segment", segment_of(F.col("r_score") + F.col("f_score") + F.col("m_score")))


def key_leaderboard(fact: DataFrame, dim_api_key: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-10: each account's keys ranked by tokens and by cost (rank per account over its keys)."""
    per = (fact.filter(in_range(F.col("request_time"), ctx))
               .groupBy("account_sk", "key_sk")
               .agg(F.count(F.lit(1)).alias("requests"),
                    F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).alias("total_tokens"),
                    money4(F.sum("cost_usd")).alias("cost_usd")))
    per = per.join(dim_api_key.select("key_sk", "key_id"), "key_sk").select(
        "account_sk", "key_id", F.col("requests").cast("bigint").alias("requests"),
        F.col("total_tokens").cast("bigint").alias("total_tokens"), "cost_usd")
    # ranks by global positions: an account with very many keys isn't gathered anywhere
    for by, name in (("total_tokens", "token_rank"), ("cost_usd", "cost_rank")):
        per = position_in_group(per, ["account_sk"], [F.col(by).desc(), "key_id"], name, ties=[by])
    return per


def top_models(fact: DataFrame, dim_model: DataFrame, ctx: MetricContext, k: int = 3) -> DataFrame:
    """S-11: each account's ``k`` most used models (ties by model_id) with mean latency."""
    per = (fact.filter(in_range(F.col("request_time"), ctx))
               .groupBy("account_sk", "model_sk")
               .agg(F.count(F.lit(1)).alias("requests"), F.avg("latency_ms").alias("_lat")))
    per = per.join(dim_model.select("model_sk", "model_id"), "model_sk")
    rn = F.row_number().over(Window.partitionBy("account_sk").orderBy(F.col("requests").desc(), "model_id"))
    return (per.withColumn("model_rank", rn).filter(F.col("model_rank") <= k)
               .select("account_sk", "model_id", F.col("requests").cast("bigint").alias("requests"),
                       round4(F.col("_lat")).alias("mean_latency_ms"), "model_rank"))


def behaviour_features(fact: DataFrame, dim_status: DataFrame, ctx: MetricContext) -> DataFrame:
    st = dim_status.select("status_sk", "is_error")
    f = fact.filter(in_range(F.col("request_time"), ctx)).join(st, "status_sk")
    return f.groupBy("account_sk").agg(
        F.count_distinct(F.to_date("request_time")).cast("double").alias("active_days"),
        F.count(F.lit(1)).cast("double").alias("requests"),
        F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).cast("double").alias("tokens"),
        money4(F.sum("revenue_usd")).cast("double").alias("spend"),
        F.count_if("is_error").alias("errors"), (F.count_if("is_error") / F.count(F.lit(1))).alias("error_rate"))


FEATURES = ("active_days", "requests", "tokens", "spend", "error_rate")
SCALE = 1000  # features as whole numbers from 0 to this
ROUNDS = 8


def scaled_features(feats: DataFrame) -> DataFrame:
    """``feats`` with each feature as a whole number, its place between the least and the greatest value. It is
    computed in whole numbers from counts and 4-decimal money, so equal inputs give equal numbers in any order."""
    whole = {"active_days": "cast(active_days as bigint)", "requests": "cast(requests as bigint)", "tokens": "cast(tokens as bigint)",
             "spend": "cast(cast(spend as decimal(18,4)) * 10000 as bigint)", "error_rate": "errors * 1000000 div cast(requests as bigint)"}
    rows = feats.select("*", *[F.expr(e).alias(f"x_{c}") for c, e in whole.items()])
    ends = rows.agg(*[f(f"x_{c}").alias(f"{n}_{c}") for c in whole for n, f in (("lo", F.min), ("hi", F.max))]).first()

    def place(c: str) -> Column:
        lo, hi = ends[f"lo_{c}"], ends[f"hi_{c}"]
        return F.expr(f"(x_{c} - {lo}) * {SCALE} div {hi - lo}") if lo is not None and hi > lo else F.lit(0).cast("bigint")

    return rows.select("account_sk", *FEATURES, *[place(c).alias(f"x_{c}") for c in FEATURES])


def kmeans_segments(fact: DataFrame, dim_status: DataFrame, ctx: MetricContext, k: int = 4, rounds: int = ROUNDS) -> DataFrame:
    """S-13: behaviour clusters by Lloyd's algorithm on scaled usage features, in whole numbers.

    The first centres are the accounts at the middles of ``k`` equal parts of the order by tokens (then
    requests, then key). A round assigns each account to the nearest centre (squared distance; ties to the lower
    number) and moves each centre to the floor of its accounts' mean; an empty cluster keeps its centre. All
    arithmetic is exact, so the result doesn't depend on the order of the rows. Only the ``k`` centres reach the driver.
    """
    from ..operators.keys import with_surrogate_key

    # one row per account, read by every round: frozen once instead of re-aggregating the fact each time
    feats = with_surrogate_key(scaled_features(freeze(behaviour_features(fact, dim_status, ctx))), ["x_tokens", "x_requests", "account_sk"], "_at")
    feats = freeze(feats)
    n = feats.count()
    xs = [f"x_{c}" for c in FEATURES]
    picks = {(2 * i + 1) * n // (2 * k) + 1: i for i in range(k)} if n >= k else {i + 1: i for i in range(n)}
    centres = {picks[r[0]]: tuple(r[1:]) for r in feats.filter(F.col("_at").isin(list(picks))).select("_at", *xs).collect()}

    def nearest() -> Column:
        options = [F.struct(sum((F.col(x) - c) * (F.col(x) - c) for x, c in zip(xs, centre, strict=True)).alias("d"), F.lit(i).alias("i"))
                   for i, centre in sorted(centres.items())]
        return F.array_min(F.array(*options))["i"] if options else F.lit(0)

    for _ in range(rounds):
        moved = feats.groupBy(nearest().alias("i")).agg(*[F.expr(f"sum({x}) div count(*)").alias(x) for x in xs]).collect()  # k rows
        new = centres | {r[0]: tuple(r[1:]) for r in moved}
        if new == centres:
            break
        centres = new
    return feats.select("account_sk", *FEATURES, nearest().cast("int").alias("cluster"))


ACCOUNT_TAG, MODEL_TAG = ["account_sk", "tag_key"], ["model_sk", "tag_key"]


def upsert_tags(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """S-14: the pool after ``new`` (one row per ``key``): changed and added tags come in with their time, tags that
    say the same keep the time they had, and so do tags that aren't in ``new``."""
    said = [c for c in new.columns if c not in (*key, "updated_at")]
    return newest_per_key(existing, new, key, said, "updated_at")


class TagPool(BucketedTable):
    """S-14: a stored tag pool (``ads_account_tags`` or ``ads_model_tags``); an upsert writes only the buckets it touches."""

    def __init__(self, spark, root: str, table: str, buckets: int = 64):
        self.key = {"ads_account_tags": ACCOUNT_TAG, "ads_model_tags": MODEL_TAG}[table]
        super().__init__(spark, root, schemas.WAREHOUSE[table], self.key[0], buckets)

    def apply(self, tags: DataFrame) -> int:
        """Publish the pool after ``tags`` (one row per key)."""
        new = freeze(schemas.conform(tags, self.schema))
        return self.upsert(new, lambda old, new: upsert_tags(old, new, self.key))


def _tag(df: DataFrame, sk: str, key: str, value: Column, when_: Column | None = None) -> DataFrame:
    if when_ is not None:
        df = df.filter(when_)
    return df.select(F.col(sk), F.lit(key).alias("tag_key"), value.cast("string").alias("tag_value"))


# Fixed values (ours): churn risk by the sum of the recency and frequency scores, 2..10.
CHURN_HIGH, CHURN_MEDIUM = 4, 6


def churn_risk(r_score: Column, f_score: Column) -> Column:
    """How likely an account is to leave: it calls rarely, and the last call was long ago."""
    total = r_score + f_score
    return F.when(total <= CHURN_HIGH, "high").when(total <= CHURN_MEDIUM, "medium").otherwise("low")


def account_tags(rfm_df: DataFrame, burn: DataFrame, traffic: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-14: account tags from RFM segments and churn risk, burn rate / run-out date and traffic alerts (each
    measure has one row per account, so a key has one tag)."""
    alerts = traffic.groupBy("account_sk").agg(F.count_if("is_alert").alias("n"))
    rows = (_tag(rfm_df, "account_sk", "segment_label", F.col("segment"))
            .unionByName(_tag(rfm_df, "account_sk", "churn_risk", churn_risk(F.col("r_score"), F.col("f_score"))))
            .unionByName(_tag(burn, "account_sk", "burn_rate", F.col("burn_slope").cast("decimal(18,4)"),
                              F.col("burn_slope").isNotNull()))
            .unionByName(_tag(burn, "account_sk", "exhaust_date", F.date_format("exhaust_date", "yyyy-MM-dd"),
                              F.col("exhaust_date").isNotNull()))
            .unionByName(_tag(alerts, "account_sk", "traffic_alerts", F.col("n"))))
    return rows.select("account_sk", "tag_key", "tag_value", F.lit(None).cast("double").alias("confidence"),
                       F.lit(ctx.end).cast("timestamp_ntz").alias("updated_at"))


def model_tags(error_rates: DataFrame, latency_z: DataFrame, dim_model: DataFrame,
               ctx: MetricContext) -> DataFrame:
    """S-14: model tags: stability rank by error rate and the largest |z| of daily latency.

    The rank is a window over one row per model (bounded by the catalogue).
    """
    er = error_rates.join(dim_model.select("model_sk", "model_id"), "model_id")
    ranked = er.withColumn("_rank", F.rank().over(Window.orderBy("error_rate")))
    zmax = (latency_z.groupBy("model_id").agg(F.max(F.abs("z_score")).alias("_z"))
            .join(dim_model.select("model_sk", "model_id"), "model_id"))
    rows = (_tag(ranked, "model_sk", "stability_rank", F.col("_rank"))
            .unionByName(_tag(zmax, "model_sk", "anomaly_score", F.col("_z").cast("decimal(18,4)"),
                              F.col("_z").isNotNull())))
    return rows.withColumn("updated_at", F.lit(ctx.end).cast("timestamp_ntz"))


def _struct_rows(df: DataFrame, code: str, entity_type: str, entity: Column, time_id: str, kind: str,
                 body: Column) -> DataFrame:
    return df.select(F.lit(code).alias("metric_code"), F.lit(entity_type).alias("entity_type"),
                     entity.cast("string").alias("entity_id"), F.lit("month").alias("time_type"),
                     F.lit(time_id).alias("time_id"), F.lit(kind).alias("struct_type"),
                     body.alias("struct_json"))


def struct_metrics(leaderboard: DataFrame, rfm_df: DataFrame, forecast: DataFrame,
                   ctx: MetricContext) -> DataFrame:
    """S-26: rank, segment and forecast results as ``dws_metric_struct`` JSON rows.

    Ranks are one row per key (the key is the entity), so every key is kept and no
    account's keys are gathered in one place.
    """
    month = ctx.end.strftime("%Y-%m")
    rank_json = F.to_json(F.struct("account_sk", F.col("token_rank").alias("rank")))
    seg_json = F.to_json(F.struct(F.col("r_score").alias("r"), F.col("f_score").alias("f"), F.col("m_score").alias("m"), "segment"))
    total = forecast.agg(F.count(F.lit(1)).alias("horizon_days"),
                         F.sum(F.col("predicted_profit_usd").cast("decimal(18,4)")).cast("decimal(18,4)").alias("forecast_profit_usd"))
    fc_json = F.to_json(F.struct("horizon_days", "forecast_profit_usd"))
    return (_struct_rows(leaderboard, "account.monthly.key_rank", "api_key", F.col("key_id"), month, "rank", rank_json)
            .unionByName(_struct_rows(rfm_df, "account.monthly.rfm", "account", F.col("account_sk"), month,
                                      "segment", seg_json))
            .unionByName(_struct_rows(total, "platform.monthly.profit_forecast", "platform", F.lit("all"), month,
                                      "forecast", fc_json)))
