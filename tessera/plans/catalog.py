"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query runs a library operator over inputs derived from whole driver tables.
Computed columns carry the same names as in ``plans.oracle.SQL``; doubles that depend
on summation order are rounded to 6 digits on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType

from tessera.functions import scalars as S
from tessera.functions.geohash import with_geohash
from tessera.operators import blend as E
from tessera.operators import boosting as X
from tessera.operators import model as M
from tessera.operators import tabular as T
from tessera.operators.cumulative import with_position
from tessera.operators.joins import align_to_template as align
from tessera.operators.joins import enrich_with_default as enrich_default
from tessera.operators.joins import drop_checked, keep_keys_in, label_files
from tessera.operators.metrics import accuracy, correlation_matrix, describe, dimension_stats, histogram, normalise
from tessera.operators.metrics import auc_exact as auc
from tessera.operators.metrics import density_grid as grid
from tessera.operators.metrics import density_smooth as smooth
from tessera.plans import flights as A
from tessera.plans import logs as C
from tessera.plans import mail as B
from tessera.plans import standins as D
from tessera.session import checkpoint_dir, written
from tessera.sources import files, sinks
from tessera.sources.files import decode_csv_lines, drop_header_lines
from tessera.sources.tables import table
from tessera.streaming.incremental import create_only_stream, mail_edges_stream, mail_stats_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def r6(c):
    return F.round(c, 6)


# ------------------------------------------------------------------ family A
def _dictionary(spark, sf_dir, legacy=False):
    return A.weather_dictionary(A.parse_weather(D.weather_lines(spark, sf_dir)), legacy_text_max=legacy)


def enriched_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights (deduplicated lines, header dropped) enriched with the weather dictionary."""
    flights = A.parse_flights(D.flight_lines(spark, sf_dir))
    return A.enrich(A.project_flights(flights), _dictionary(spark, sf_dir))


@register("weather_max_by_key")
def weather_max_by_key(spark, sf_dir):
    w = A.parse_weather(D.weather_lines(spark, sf_dir))
    keyed = w.select("airport", "date", S.hour_of_hhmm("time").alias("hour"), F.nanvl(S.parse_float("temperature"), F.lit(None).cast("double")).alias("t"))
    # Unparsable readings are skipped by max/count themselves; filtering after the
    # aggregate keeps the CSV decode from being evaluated a second time in a pushed filter.
    agg = keyed.groupBy("airport", "date", "hour").agg(F.max("t").alias("max_temp"), F.count("t").alias("n_readings"))
    return agg.where(F.col("n_readings") > 0)


@register("weather_max_text_legacy")
def weather_max_text_legacy(spark, sf_dir):
    d = _dictionary(spark, sf_dir, legacy=True)
    return d.select("airport", "date", "hour", F.col("temperature_text").alias("max_temp_text"), F.col("temperature").alias("max_temp"))


@register("enrich_with_default")
def enrich_with_default(spark, sf_dir):
    return A.with_legacy_temperature(enriched_flights(spark, sf_dir))


@register("daily_max_converted")
def daily_max_converted(spark, sf_dir):
    out = A.daily_max_celsius(enriched_flights(spark, sf_dir))
    return out.withColumn("max_temp_c", r6(F.col("max_temp_c")))


def projected_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights before the lookup join. The enrichment keeps exactly one row per flight
    and the count reports read no temperature, so they are computed without the join."""
    return A.project_flights(A.parse_flights(D.flight_lines(spark, sf_dir)))


@register("delay_flag_counts")
def delay_flag_counts(spark, sf_dir):
    return A.delay_counts(projected_flights(spark, sf_dir))


@register("count_by_key")
def count_by_key(spark, sf_dir):
    return A.flights_per_airline(projected_flights(spark, sf_dir))


@register("count_by_key_day")
def count_by_key_day(spark, sf_dir):
    return A.flights_per_airline_day(projected_flights(spark, sf_dir))


@register("distinct_raw_lines")
def distinct_raw_lines(spark, sf_dir):
    lines = drop_header_lines(D.lineitem_lines(spark, sf_dir), A.HEADER_FIRST_FIELD).distinct()
    return decode_csv_lines(lines, D.LINEITEM_LINE_FIELDS)


@register("geohash_points")
def geohash_points(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    pts = c.select(
        "c_custkey",
        ((F.pmod(F.col("c_custkey") * 37, F.lit(18001)) - 9000) / F.lit(100.0)).alias("lat"),
        ((F.pmod(F.col("c_custkey") * 53, F.lit(36001)) - 18000) / F.lit(100.0)).alias("lon"),
    )
    return with_geohash(pts, "lat", "lon", text_input=False)


@register("route_and_pad")
def route_and_pad(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return j.select(
        "c_custkey",
        S.route("n_name", "c_mktsegment").alias("route"),
        S.pad_right(F.col("c_custkey").cast("string"), 10).alias("code_short"),
        S.pad_right("c_name", 10).alias("code_long"),
    )


# ------------------------------------------------------------------ family B
def _mail_records(spark, sf_dir):
    return B.parse_records(D.mail_rows(spark, sf_dir))


@register("mail_parse")
def mail_parse(spark, sf_dir):
    return _mail_columns(_mail_records(spark, sf_dir))


def _mail_columns(r):
    return r.select(
        "timestamp_iso",
        "`message identifier`",
        "sender",
        F.concat_ws("|", "recipients").alias("recipients_text"),
        F.col("attributes")[0]["value"].cast("bigint").alias("n_recipients"),
        F.col("recipients")[0].alias("first_recipient"),
        F.element_at("recipients", -1).alias("last_recipient"),
        "topic",
        "email",
    )


@register("mail_user_stats")
def mail_user_stats(spark, sf_dir):
    return B.user_stats(_mail_records(spark, sf_dir))


@register("mail_user_stats_all")
def mail_user_stats_all(spark, sf_dir):
    return B.user_stats(_mail_records(spark, sf_dir), include_receivers=True)


@register("mail_edges_all")
def mail_edges_all(spark, sf_dir):
    return B.edges(_mail_records(spark, sf_dir))


@register("mail_edges_last")
def mail_edges_last(spark, sf_dir):
    return B.edges(_mail_records(spark, sf_dir), last_only=True)


# ------------------------------------------------------------------ family C
# Search parameters of the registered queries.
SEARCH_HOST = "web-1"
SEARCH_NAME = "error"
COPY_HOST = "web-2"


@register("log_json_search")
def log_json_search(spark, sf_dir):
    return C.search(D.log_docs(spark, sf_dir), host=SEARCH_HOST, name=SEARCH_NAME)


@register("log_search_analyzed")
def log_search_analyzed(spark, sf_dir):
    return C.search(D.log_docs(spark, sf_dir), host=SEARCH_HOST, name="click", analyzed=True, size=None)


@register("log_rejected_messages")
def log_rejected_messages(spark, sf_dir):
    bad = C.rejected_messages(D.log_docs(spark, sf_dir))
    return bad.select("_id", "host", "event_type")


@register("create_only_copy")
def create_only_copy(spark, sf_dir):
    docs = D.log_docs(spark, sf_dir)
    source = docs.where(C.match_host("host", COPY_HOST))
    destination = docs.where(F.col("event_type") == "view")
    return C.copy_new(source, destination).select("_id", "host", "day", "event_type")


@register("two_source_copy")
def two_source_copy(spark, sf_dir):
    docs = D.log_docs(spark, sf_dir)
    keyed = docs.select(
        F.concat(F.lit("u"), F.col("_seq").cast("string").substr(-1, 1), F.lit("-"), F.hour("@timestamp").cast("string")).alias("_id"),
        "host",
        "@timestamp",
        "day",
        "_seq",
    )
    out = C.two_source_copy(keyed, host_today=COPY_HOST, host_yesterday=COPY_HOST, row_id="_seq")
    return out.select("target_day", "_id", "priority", F.col("_seq").alias("event_id"), "day")


# ------------------------------------------------------------------ family D
FEATURE_COLUMNS = ["engine_num", "app_num", "sig_num", "first", "second", "third", "fourth", "fifth"]


def _version_features(spark, sf_dir):
    rows = D.version_rows(spark, sf_dir)
    return T.version_features(rows, "version", "version", "version", "build_lab")


@register("version_features")
def version_features(spark, sf_dir):
    clean, _ = T.split_rejects(_version_features(spark, sf_dir))
    return clean.select("p_partkey", "version", "build_lab", *FEATURE_COLUMNS)


@register("reject_bad_versions")
def reject_bad_versions(spark, sf_dir):
    _, bad = T.split_rejects(_version_features(spark, sf_dir))
    return bad.select("p_partkey", "version", "build_lab", "reject_reason")


CATEGORY_COLUMNS = ["p_brand", "p_type", "p_name"]
HELD_OUT_BRAND = "Brand#7"


def _coding_input(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    is_test = (F.pmod("p_partkey", F.lit(5)) == 0) | (F.col("p_brand") == HELD_OUT_BRAND)
    return p.select(
        "p_partkey",
        "p_brand",
        "p_type",
        F.when(F.col("p_size") == 1, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("p_name"),
        F.when(is_test, F.lit("test")).otherwise(F.lit("train")).alias("split"),
    )


@register("factorize_train_test")
def factorize_train_test(spark, sf_dir):
    data = _coding_input(spark, sf_dir)
    codes = T.fit_codes(data.where(F.col("split") == "train"), CATEGORY_COLUMNS, "p_partkey")
    coded = T.apply_codes(data, codes, CATEGORY_COLUMNS)
    return coded.select("p_partkey", "split", "p_brand_code", "p_type_code", "p_name_code")


VERSION_DATE_CUTOFF = "1998-01-01 00:00:00"


@register("version_date_lookup")
def version_date_lookup(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    dictionary = o.groupBy(F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("version")).agg(F.max("o_orderdate").alias("date"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("v"), F.col("l_orderkey").cast("string")).alias("version"))
    mapped = enrich_default(li, dictionary, ["version"], "date")
    return mapped.where(F.col("date") > F.lit(VERSION_DATE_CUTOFF).cast("timestamp_ntz")).select("l_orderkey", "l_linenumber", "l_partkey", "date")


@register("column_profile")
def column_profile(spark, sf_dir):
    return T.column_profile(table(spark, sf_dir, "lineitem")).select("column_name", "non_null", "n_rows")


@register("kfold_contiguous")
def kfold_contiguous(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return T.contiguous_folds(o, ["o_orderkey"], 5)


@register("kfold_hashed")
def kfold_hashed(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return T.hashed_folds(o, "o_orderkey", 5, seed=15)


@register("sample_stable")
def sample_stable(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return T.stable_sample(o, "o_orderkey", 0.2, seed=7)


# ------------------------------------------------------------------ metrics and blending
SCORE_COLS = ["score_a", "score_b", "score_c"]


@register("auc_exact")
def auc_exact(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    out = auc(d.join(lab, "doc_id"), "quality", "n_chars")
    return out.select(r6(F.col("auc")).alias("auc"), "n_pos", "n_neg")


@register("blend_inner_mean")
def blend_inner_mean(spark, sf_dir):
    out = E.blend_files(D.score_files(spark, sf_dir), "id", SCORE_COLS)
    return out.select("id", *SCORE_COLS, r6(F.col("mean")).alias("mean"))


@register("blend_weighted")
def blend_weighted(spark, sf_dir):
    a, b, _ = D.score_files(spark, sf_dir)
    out = E.snap(E.weighted(a.join(b, "id"), ["score_a", "score_b"], [0.7, 0.3]), "blend")
    return out.select("id", r6(F.col("blend")).alias("blend"), r6(F.col("snapped")).alias("snapped"))


@register("snap_extremes")
def snap_extremes(spark, sf_dir):
    a, _, _ = D.score_files(spark, sf_dir)
    return E.snap(a, "score_a").select("id", "score_a", "snapped")


@register("corr_matrix")
def corr_matrix(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = correlation_matrix(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return out.select("col_a", "col_b", r6(F.col("r")).alias("r"))


@register("describe_scores")
def describe_scores(spark, sf_dir):
    out = describe(table(spark, sf_dir, "events"), "value")
    return out.select("count", *[r6(F.col(c)).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max", "delta"]])


HIST_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("histogram_columns")
def histogram_columns(spark, sf_dir):
    out = histogram(table(spark, sf_dir, "lineitem"), HIST_COLS)
    return out.select("column", "bin", r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"), "count")


TOP_K = 1000
SHARE_CUT = 0.003


def _top_features(imp, k=TOP_K):
    return (
        imp.groupBy("feature")
        .agg(F.avg("importance").alias("mean_importance"), F.sum("importance").alias("total"))
        .orderBy(F.col("mean_importance").desc(), F.col("feature"))
        .limit(k)
    )


@register("topk_groups")
def topk_groups(spark, sf_dir):
    top = _top_features(D.importances(spark, sf_dir))
    return top.select("feature", r6(F.col("mean_importance")).alias("mean_importance"))


@register("importance_report")
def importance_report(spark, sf_dir):
    """Rows of the top features with their share of the total. The top table (TOP_K rows)
    is written once; it gives the total and filters the rows."""
    imp = D.importances(spark, sf_dir)
    top = written(_top_features(imp), "top-features")
    total = top.agg(F.sum("total")).scalar()  # scalar subquery, computed once
    best = keep_keys_in(imp, F.broadcast(top.select("feature")), "feature")  # TOP_K rows
    shared = best.withColumn("share", F.lit(100.0) * F.col("importance") / total)
    kept = shared.where(F.col("share") > F.lit(SHARE_CUT))
    return kept.select("feature", "fold", "importance", r6(F.col("share")).alias("share"))


#: The fold and the importance cut of the importance analysis.
CUT_FOLD, CUT_IMPORTANCE = 1, 44


@register("importance_cuts")
def importance_cuts(spark, sf_dir):
    """How many importance rows the fold and importance cuts keep."""
    in_fold = F.col("fold") == CUT_FOLD
    return D.importances(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(in_fold).alias("n_fold"), F.count_if(in_fold & (F.col("importance") > CUT_IMPORTANCE)).alias("n_kept")
    )


@register("id_from_path")
def id_from_path(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", S.id_from_path("url").alias("url_id"))


@register("align_to_template")
def align_to_template(spark, sf_dir):
    template = table(spark, sf_dir, "documents").select("doc_id")
    values = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return align(template, values, "doc_id")


def _model_scores(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("model"), (F.col("l_discount") * F.lit(10.0)).alias("score"))


@register("ensemble_threshold")
def ensemble_threshold(spark, sf_dir):
    out = E.ensemble(_model_scores(spark, sf_dir), "id", "score")
    return out.select("id", r6(F.col("score")).alias("score"), "label")


@register("ensemble_accuracy")
def ensemble_accuracy(spark, sf_dir):
    pred = E.ensemble(_model_scores(spark, sf_dir), "id", "score")
    truth = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").cast("int").alias("truth"))
    out = accuracy(pred.join(truth, "id"), "label", "truth")
    return out.select(r6(F.col("accuracy")).alias("accuracy"), "n")


@register("normalise_dimensions")
def normalise_dimensions(spark, sf_dir):
    out = dimension_stats(table(spark, sf_dir, "embeddings"), "embedding")
    return out.select("pos", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"))


DENSITY_WX, DENSITY_WY = 5.0, 10000.0


@register("density_grid")
def density_grid(spark, sf_dir):
    return grid(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", DENSITY_WX, DENSITY_WY)


@register("density_smooth")
def density_smooth(spark, sf_dir):
    g = grid(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", DENSITY_WX, DENSITY_WY)
    return smooth(g).select("gx", "gy", r6(F.col("density")).alias("density"))


# ------------------------------------------------------------------ model (rows-only check)
GBT_FEATURES = ["o_totalprice", "priority", "order_year", "cust_bucket", "constant"]


GBT_PARAMS = M.gbt_params(leaves=16, min_rows=20, rounds=20, learning_rate=0.2, feature_share=1.0)
N_FOLDS = 5
#: A model has learnt if its AUC is above that of its best single number by this much.
GAIN = 0.1


def _order_features(spark, sf_dir):
    """Features of every order, and a label that they explain except for a tenth of the
    orders, where it is turned round: a set of priorities, or both a late year and a customer
    number divisible by seven. ``constant`` says nothing."""
    bucket, year = F.pmod("o_custkey", F.lit(100)), F.year("o_orderdate")
    priority = F.substring("o_orderpriority", 1, 1)
    signal = 2 * priority.isin("1", "4").cast("int") + (year >= 1998).cast("int") + (bucket % 7 == 0).cast("int")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        priority.try_cast("double").alias("priority"),
        priority.alias("priority_code"),
        year.cast("double").alias("order_year"),
        bucket.cast("double").alias("cust_bucket"),
        F.lit(1.0).alias("constant"),
        ((signal >= 2) != (S.hash_unit("o_orderkey", 33) < 0.1)).cast("double").alias("label"),
    )


def _in_range(name):
    return F.coalesce(F.col(name).between(0.0, 1.0), F.lit(False))


def _learnt(scored, by="order_year"):
    """The AUC of one feature over the rows, and whether that of ``score`` is well above it."""
    single, model = auc(scored, "label", by).select("auc").scalar(), auc(scored, "label", "score").select("auc").scalar()
    return r6(single).alias("feature_auc"), (model > single + F.lit(GAIN)).alias("beats_feature")


@register("train_score_gbt")
def train_score_gbt(spark, sf_dir):
    """Hold-out split, boosted trees with early stopping on an inner validation
    share (``validationIndicatorCol``), scores for the held-out rows. The scores are the
    learner's own, so the query returns the ids, whether each is a probability, and whether
    they rank the rows better than a feature does."""
    data = written(_order_features(spark, sf_dir), "order-features")
    train, valid = T.holdout_split(data, "o_orderkey", 0.2, seed=15)
    train = train.withColumn("is_valid", S.hash_unit("o_orderkey", 21) < F.lit(0.1))
    fitted = M.train(train, GBT_FEATURES, "label", GBT_PARAMS, validation_col="is_valid")
    scored = written(M.score(fitted, valid, "o_orderkey").join(valid.select("o_orderkey", "label", "order_year"), "o_orderkey"), "scored")
    return scored.select("o_orderkey", "label", _in_range("score").alias("score_in_range"), *_learnt(scored))


def _gappy_features(spark, sf_dir):
    """The order features with missing prices, as NULL or NaN, where the label needs them to be
    known as missing."""
    gap = F.when(F.col("o_custkey") % 2 == 0, F.lit(float("nan")))
    missing = F.col("cust_bucket") % 7 == 0
    return _order_features(spark, sf_dir).withColumn("price", F.when(missing, gap).otherwise(F.col("o_totalprice")))


PATIENCE = {"params": GBT_PARAMS | {"stepSize": 0.5}, "patience": 2, "max_rounds": 16, "block": 8}
NUMBERS, CODES = ["price", "order_year", "constant"], ["priority_code"]


@register("train_patience")
def train_patience(spark, sf_dir):
    """E9/E10 with patience: categories as nominal attributes, missing numbers marked, rounds
    until the held-out loss has not fallen for a while, scores at the best round."""
    data = written(_gappy_features(spark, sf_dir), "gappy-features")
    train, valid = T.holdout_split(data, "o_orderkey", 0.2, seed=15)
    fitted = X.fit(train, valid, "label", NUMBERS, CODES, **PATIENCE)
    scored = written(X.score(fitted, valid, "o_orderkey", "label", "order_year"), "scored")
    waited = fitted.rounds >= min(fitted.best_round + PATIENCE["patience"], PATIENCE["max_rounds"])
    best = fitted.losses[fitted.best_round - 1] == min(fitted.losses[: fitted.best_round + PATIENCE["patience"]])
    trees = fitted.model.stages[-1].getNumTrees == fitted.best_round
    return scored.select("o_orderkey", "label", _in_range("score").alias("score_in_range"), F.lit(waited and best and trees).alias("best_prefix"), *_learnt(scored))


def _split_counts(spark, sf_dir, folds=range(2)):
    data = T.hashed_folds(_gappy_features(spark, sf_dir), "o_orderkey", 2, seed=15)
    return X.folds_with_patience(data, "label", "o_orderkey", "fold", folds, NUMBERS, CODES, **PATIENCE)


@register("split_count_report")
def split_count_report(spark, sf_dir):
    """E12 as the original counts: splits a feature over the fitted trees of each fold, the
    top features, their shares. Returns whether the counts are those of the trees' inner
    nodes, the shares make up 100, and which feature leads and which is never used."""
    _, imps, fits = _split_counts(spark, sf_dir)
    imps = written(X.top_shares(imps), "split-counts")
    inner = sum(X.nodes(f).where("splits").count() for f in fits.values())
    whole = imps.agg(F.sum("importance")).scalar() == F.lit(float(inner))
    shares = F.abs(imps.agg(F.sum("share")).scalar() - F.lit(100.0)) < 1e-6
    per = imps.groupBy("feature").agg(F.avg("importance").alias("mean"), F.count(F.lit(1)).alias("n_runs"))
    return per.select("feature", "n_runs", whole.alias("counts_inner_nodes"), shares.alias("shares_complete"), (F.col("mean") == 0).alias("is_unused"))


@register("keep_list_refit")
def keep_list_refit(spark, sf_dir):
    """E12 -> E9: the features above a cut of split counts in one fold are the feature list of
    the next fit."""
    _, imps, _ = _split_counts(spark, sf_dir, folds=[1])
    kept = X.keep_list(imps, fold=1, least=0)
    data = written(T.hashed_folds(_gappy_features(spark, sf_dir), "o_orderkey", 2, seed=15), "refit")
    held = data.where("fold = 1")
    fitted = X.fit(data.where("fold != 1"), held, "label", [c for c in NUMBERS if c in kept], [c for c in CODES if c in kept], **PATIENCE)
    scored = written(X.score(fitted, held, "o_orderkey", "label", "order_year"), "scored")
    return scored.select("o_orderkey", F.lit(",".join(kept)).alias("kept"), _in_range("score").alias("score_in_range"), *_learnt(scored))


# ------------------------------------------------------------------ streaming (batch-equivalent SQL)
def _file_stream(spark, sf_dir, name):
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # A file stream watches a folder or a glob; the glob matches exactly this table.
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf_dir.rstrip('/')}/{name}.parq[u]et")


@register("stream_create_only")
def stream_create_only(spark, sf_dir):
    stream_docs = D.log_docs(spark, sf_dir, events=_file_stream(spark, sf_dir, "events"))
    source = stream_docs.where(C.match_host("host", COPY_HOST))
    destination = D.log_docs(spark, sf_dir).where(F.col("event_type") == "view")
    out = create_only_stream(spark, source, destination)
    return out.select("_id", "host", "day", "event_type")


@register("stream_mail_stats")
def stream_mail_stats(spark, sf_dir):
    rows = D.mail_rows(spark, sf_dir, lineitem=_file_stream(spark, sf_dir, "lineitem"))
    return mail_stats_stream(spark, B.parse_records(rows))


def _out_of_fold(spark, sf_dir):
    data = T.hashed_folds(_order_features(spark, sf_dir), "o_orderkey", N_FOLDS, seed=15)
    return M.out_of_fold(data, GBT_FEATURES, "label", "o_orderkey", "fold", range(N_FOLDS), GBT_PARAMS)


@register("oof_predictions")
def oof_predictions(spark, sf_dir):
    """Out-of-fold scores of all folds, one row per order, and whether the rounded scores
    are right more often than the commoner label would be."""
    preds = written(_out_of_fold(spark, sf_dir)[0], "oof")
    ones = preds.agg(F.avg("label")).scalar()
    right = preds.agg(F.avg(((F.col("score") > 0.5).cast("double") == F.col("label")).cast("double"))).scalar()
    share = F.greatest(ones, F.lit(1.0) - ones)
    return preds.select("o_orderkey", "fold", "label", _in_range("score").alias("score_in_range"), r6(share).alias("majority_share"), (right > share + F.lit(GAIN)).alias("beats_majority"))


@register("gbt_importance_report")
def gbt_importance_report(spark, sf_dir):
    """Per-fold importances -> mean per feature -> share of the total, all folds.
    Returns the features with their number of fits, whether the shares make up 100, which
    one leads and which is never used."""
    _, imps = _out_of_fold(spark, sf_dir)
    mean = imps.groupBy("feature").agg(F.avg("importance").alias("mean_importance"), F.count(F.lit(1)).alias("n_runs"))
    total = mean.agg(F.sum("mean_importance")).scalar()
    shares = mean.withColumn("share", F.lit(100.0) * F.col("mean_importance") / total)
    whole, most = shares.agg(F.sum("share")).scalar(), shares.agg(F.max("share")).scalar()
    complete = F.col("share").between(0.0, 100.0) & (F.abs(whole - F.lit(100.0)) < 1e-6)
    return shares.select("feature", "n_runs", complete.alias("shares_complete"), (F.col("share") == most).alias("leads"), (F.col("share") == 0).alias("is_unused"))


@register("tta_blend")
def tta_blend(spark, sf_dir):
    """E14 + SC23: per id, average and maximum over variants, then a 0.5/0.5 blend."""
    s = _model_scores(spark, sf_dir)
    per = s.groupBy("id").agg(F.avg("score").alias("tta_avg"), F.max("score").alias("tta_max"))
    out = per.withColumn("blend", S.weighted_blend(["tta_avg", "tta_max"], [0.5, 0.5]))
    return out.select("id", r6(F.col("tta_avg")).alias("tta_avg"), r6(F.col("tta_max")).alias("tta_max"), r6(F.col("blend")).alias("blend"))


LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@register("line_positions")
def line_positions(spark, sf_dir):
    """Q6 fix + SC13: rows numbered 1..n in a total order (distributed prefix count over
    the whole table) and a re-runnable id from (source, row number)."""
    li = table(spark, sf_dir, "lineitem").select(*LINE_ORDER)
    pos = with_position(li, LINE_ORDER, name="row_number")
    out = pos.withColumn("row_number", F.col("row_number") + 1)
    return out.withColumn("unique_id", S.stable_id(F.lit("lineitem"), "row_number"))


@register("holdout_split")
def holdout_split(spark, sf_dir):
    """80/20 train/validation membership by hashed id (no shuffle, repeatable)."""
    return T.holdout_label(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.2, seed=15)


@register("sigmoid_scores")
def sigmoid_scores(spark, sf_dir):
    """SC25 + SC26: class-1 probability from a logit, then the 0/1 decision."""
    d = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") / F.lit(1000.0) - F.lit(3.0)).alias("logit"))
    p = d.withColumn("p", S.sigmoid("logit"))
    return p.select("doc_id", r6(F.col("p")).alias("p"), S.threshold("p").alias("label"))


@register("stream_mail_edges")
def stream_mail_edges(spark, sf_dir):
    """ST2 (A9): connection weights kept as streaming state."""
    rows = D.mail_rows(spark, sf_dir, lineitem=_file_stream(spark, sf_dir, "lineitem"))
    return mail_edges_stream(spark, B.parse_records(rows))


@register("oof_auc_mean")
def oof_auc_mean(spark, sf_dir):
    """A18 + A19: exact AUC of each fold's out-of-fold predictions (one grouped running sum),
    then their mean; returns the number of fits, whether the mean is an AUC, and whether it is
    above the mean AUC of a feature."""
    preds = written(_out_of_fold(spark, sf_dir)[0], "oof")
    years = preds.join(_order_features(spark, sf_dir).select("o_orderkey", "order_year"), "o_orderkey")
    single = auc(years, "label", "order_year", group_cols=["fold"]).agg(F.avg("auc")).scalar()
    mean = auc(preds, "label", "score", group_cols=["fold"]).agg(F.avg("auc").alias("mean_auc"), F.count("auc").alias("n_runs"))
    return mean.select("n_runs", _in_range("mean_auc").alias("mean_auc_in_range"), r6(single).alias("mean_feature_auc"), (F.col("mean_auc") > single + F.lit(GAIN)).alias("beats_feature"))


# ------------------------------------------------------------------ more inventory rows
@register("normalise_vectors")
def normalise_vectors(spark, sf_dir):
    """``(x - mean) / std`` per position of every vector."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    z = normalise(e, "embedding", dimension_stats(e, "embedding"))
    return z.select("vec_id", F.posexplode("normalised").alias("pos", "z")).withColumn("z", F.round("z", 4) + F.lit(0.0))


@register("daily_copy_run")
def daily_copy_run(spark, sf_dir):
    """SRC9 + SC15 + U4: the copy of one run date, its two source days and its target name."""
    out = C.daily_copy(D.log_docs(spark, sf_dir), RUN_DATE, COPY_HOST, COPY_HOST, row_id="_seq")
    return out.select("target_day", "_id", "priority", F.col("_seq").alias("event_id"), "day", F.lit(C.target_name("copy", RUN_DATE)).alias("target"))


RUN_DATE = "2024-01-02"


@register("daily_copy_tables")
def daily_copy_tables(spark, sf_dir):
    """SRC9 + SNK7: source and target as tables with a folder a day; two run dates are copied,
    each twice, and the target is read back."""
    source, target = _new_folder(spark, "logs-by-day"), _new_folder(spark, "copies-by-day")
    docs = D.log_docs(spark, sf_dir)
    hour = F.concat(F.lit("u"), F.col("_seq").cast("string").substr(-1, 1), F.lit("-"), F.hour("@timestamp").cast("string"))
    C.write_by_day(docs.withColumn("_id", hour), source)
    for run_date in (RUN_DATE, RUN_DATE, "2024-01-03", "2024-01-03"):
        C.copy_day(spark, source, target, run_date, COPY_HOST, COPY_HOST)
    out = spark.read.parquet(target)
    return out.select("target_day", "run", "_id", "priority", F.col("_seq").alias("event_id"), "day", "event_type")


@register("preview_rows")
def preview_rows(spark, sf_dir):
    """The first ten rows of a table, by id."""
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type").orderBy("p_partkey").limit(10)


@register("prepared_columns")
def prepared_columns(spark, sf_dir):
    """E2 + P7: the features of every row, rejected ones with default values, by type."""
    every = T.with_reject_defaults(_version_features(spark, sf_dir)).select("p_partkey", *FEATURE_COLUMNS)
    by_type = [*T.columns_of_type(every, LongType), *T.columns_of_type(every, IntegerType), *T.columns_of_type(every, StringType), *T.columns_of_type(every, DoubleType)]
    return every.select(*[r6(F.col(c)).alias(c) if c == "fifth" else c for c in by_type])


@register("text_columns")
def text_columns(spark, sf_dir):
    """The text columns of a table, chosen by type."""
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", *T.columns_of_type(part))


@register("dropped_columns")
def dropped_columns(spark, sf_dir):
    """P5: a table without some columns, which must be there."""
    return drop_checked(table(spark, sf_dir, "customer"), ["c_acctbal", "c_mktsegment"])


@register("mail_csv_scan")
def mail_csv_scan(spark, sf_dir):
    """SRC3: mail rows as headerless CSV files, scanned in splits and parsed."""
    path = _new_folder(spark, "mail-csv")
    D.mail_rows(spark, sf_dir).write.options(**files.CSV_OPTIONS).csv(path)
    return _mail_columns(B.parse_records(files.read_mail_csv(spark, path)))


@register("log_search_capped")
def log_search_capped(spark, sf_dir):
    """The first hits of a search in a total order."""
    return C.search(D.log_docs(spark, sf_dir), host=SEARCH_HOST, name=SEARCH_NAME, size=SEARCH_SIZE)


SEARCH_SIZE = 50


@register("one_decimal_text")
def one_decimal_text(spark, sf_dir):
    """SC7: numbers as text with one decimal."""
    return table(spark, sf_dir, "orders").select("o_orderkey", S.format_one_decimal(F.col("o_custkey") / F.lit(7.0)).alias("text"))


@register("binary_files_labelled")
def binary_files_labelled(spark, sf_dir):
    """SRC10 + J6: pages as binary files, one a folder, read with their sizes and contents and
    joined to labels by id."""
    path = _new_folder(spark, "page-files")
    pages = table(spark, sf_dir, "pages").select("page_id", F.coalesce("html", F.lit("")).alias("value"))
    sinks.write_key_files(pages, path, "page_id", "page.txt")
    found = files.read_image_folder(spark, path, ".txt").select("page_id", "length", F.sha2("content", 256).alias("sha256"))
    found = found.coalesce(16 * spark.sparkContext.defaultParallelism)  # by default a task for each 32 files, however small
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("label"))
    return label_files(found, labels, "page_id").select("page_id", "label", "length", "sha256")


def machine_lines(customers):
    """CSV lines in the declared machine schema, one a customer; every 11th has a text and
    every 13th a number too large in a small-number column, every 17th ends early."""
    key = F.col("c_custkey")
    fields = []
    for j, (_, kind) in enumerate(files.MACHINE_COLUMNS):
        plain = {"category": F.concat(F.lit("c"), F.pmod(key + j, F.lit(7))), "float32": F.concat(F.pmod(key + j, F.lit(50)), F.lit(".5"))}.get(kind, F.pmod(key + j, F.lit(100)).cast("string"))
        if j == 0:
            plain = F.concat(F.lit("m"), key)
        elif j == BROKEN_TEXT:
            plain = F.when(key % 11 == 0, F.lit("x")).otherwise(plain)
        elif j == BROKEN_NUMBER:
            plain = F.when(key % 13 == 0, F.lit("300")).otherwise(plain)
        fields.append(plain)
    whole, short = F.concat_ws(",", *fields), F.concat_ws(",", *fields[:40])
    return customers.select(F.when(key % 17 == 0, short).otherwise(whole).alias("value"))


BROKEN_TEXT, BROKEN_NUMBER = 5, 7  # two of the int8 columns


@register("checked_csv_rejects")
def checked_csv_rejects(spark, sf_dir):
    """SRC4: lines in the declared 83-column schema; those that fit with some typed values,
    the others with their text."""
    path = _new_folder(spark, "machines")
    sinks.write_text_lines(machine_lines(table(spark, sf_dir, "customer")), path)
    rows, rejects = files.read_checked_csv(spark, path, files.machine_schema(), header=False)
    good = rows.select("MachineIdentifier", F.col("IsBeta").cast("int").alias("is_beta"), F.col("RtpStateBitfield").cast("double").alias("bits"), F.lit(None).cast("string").alias("line"))
    bad = rejects.select(F.element_at(F.split("line", ","), 1).alias("MachineIdentifier"), F.lit(None).cast("int").alias("is_beta"), F.lit(None).cast("double").alias("bits"), "line")
    return good.unionByName(bad)


def _new_folder(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("text_lines_round_trip")
def text_lines_round_trip(spark, sf_dir):
    """SNK1 + SRC1: lines written as sharded text, read again and decoded."""
    path = _new_folder(spark, "lines")
    sinks.write_text_lines(D.weather_lines(spark, sf_dir), path)
    return A.parse_weather(files.read_lines(spark, path)).select("airport", "date", "time", "temperature")


@register("json_records_round_trip")
def json_records_round_trip(spark, sf_dir):
    """SNK2: mail records as JSON lines, read again."""
    path = _new_folder(spark, "records")
    records = _mail_records(spark, sf_dir)
    sinks.write_json_records(records, path)
    back = spark.read.schema(records.schema).json(path)
    return back.select("`message identifier`", "sender", F.concat_ws("|", "recipients").alias("recipients_text"), "timestamp_iso")


@register("stats_csv_round_trip")
def stats_csv_round_trip(spark, sf_dir):
    """SNK4 + O3: the sorted statistics file, read again."""
    path = _new_folder(spark, "stats")
    sinks.write_stats_csv(mail_user_stats(spark, sf_dir), path)
    schema = "user string, received long, sent long"
    return spark.read.schema(schema).options(header=True, escape='"', enforceSchema=True).csv(path)


@register("prediction_csv_round_trip")
def prediction_csv_round_trip(spark, sf_dir):
    """SNK5 + SNK8 + SRC5: a gzip submission file, read again as a score file."""
    path = _new_folder(spark, "submission")
    sinks.write_prediction_csv(D.score_files(spark, sf_dir)[0], path, "id", "score_a", compression="gzip")
    return files.read_score_file(spark, path, "id", "label")


@register("typed_csv_round_trip")
def typed_csv_round_trip(spark, sf_dir):
    """SRC4: a headered CSV read with a declared schema."""
    path = _new_folder(spark, "typed")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    rows.write.options(header=True).csv(path)
    return files.read_typed_csv(spark, path, rows.schema)


@register("lookup_round_trip")
def lookup_round_trip(spark, sf_dir):
    """SNK6 + SRC7: a version dictionary written as Parquet, read as a lookup."""
    path = _new_folder(spark, "lookup")
    o = table(spark, sf_dir, "orders")
    sinks.write_columnar(o.select(F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("version"), F.col("o_orderdate").alias("ts")), path)
    return files.read_lookup(spark, path).select("version", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"))


@register("template_round_trip")
def template_round_trip(spark, sf_dir):
    """SRC11 + J4: labels aligned to a template file of ids."""
    path = _new_folder(spark, "template")
    table(spark, sf_dir, "documents").select("doc_id").write.options(header=True).csv(path)
    template = files.read_id_template(spark, path).select(F.col("doc_id").cast("long").alias("doc_id"))
    return align(template, table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")


@register("archive_round_trip")
def archive_round_trip(spark, sf_dir):
    """SNK3: lines archived as gzip under their run date, read again and decoded."""
    path = _new_folder(spark, "raw")
    sinks.write_text_lines(D.weather_lines(spark, sf_dir), path)
    archived = sinks.archive_raw(spark, path, _new_folder(spark, "archive"), RUN_DATE)
    return A.parse_weather(files.read_lines(spark, archived)).select("airport", "date", "time", "temperature")


@register("labelled_files")
def labelled_files(spark, sf_dir):
    """J6 + SC21: files joined to their labels by the id in their path."""
    path = F.concat(F.lit("train/"), F.col("doc_id").cast("string"), F.lit(".tif"))
    found = table(spark, sf_dir, "documents").select(path.alias("path")).withColumn("id", S.id_from_path("path"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), F.col("quality").alias("label"))
    return label_files(found, labels).select("path", "label")


@register("gbt_parameter_sets")
def gbt_parameter_sets(spark, sf_dir):
    """Every named parameter set on one hashed test share; returns whether each got an
    exact AUC."""
    data = written(_order_features(spark, sf_dir), "order-features")
    out = M.compare_sets(data, GBT_FEATURES, "label", "o_orderkey")
    test = data.where(S.hash_unit("o_orderkey", 15) < 0.2)
    single = auc(test, "label", "order_year").select("auc").scalar()
    return out.select("name", _in_range("auc").alias("auc_in_range"), r6(single).alias("feature_auc"), (F.col("auc") > single + F.lit(GAIN)).alias("beats_feature"))
