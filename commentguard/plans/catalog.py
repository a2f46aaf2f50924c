"""Registered queries: each binds fixtures (derived from the test tables) to an
operator, and most carry the DuckDB SQL that must give the same rows.

Float results are rounded to 6 decimals on both sides, as summation order
differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import vocab as V
from ..functions import scores as S
from ..functions import text as TX
from ..operators import accents as AC, collect as CL, heads as HD, lattice as LT
from ..operators import metrics as M
from ..operators import monitor as MO
from ..operators import scoring as SC
from ..operators import splits as SP
from ..operators import tags as TG
from ..operators.cleaning import clean_comments, prepare_lexicons
from ..sources import payload as PL
from ..streaming.ingest import for_scoring
from . import fixtures as FX
from . import oracle as O

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _q(s):
    return "'" + s.replace("'", "''") + "'"


DOCS_SQL = "SELECT doc_id AS id, text AS cmt FROM documents"


# ------------------------------------------------------------------ cleaning
@query("q_clean_online", O.q_clean_online())
def q_clean_online(spark, sf):
    ab, co, sw = FX.fixture_lexicons(spark)
    return clean_comments(FX.comments(spark, sf), ab, co, sw)


@query("q_clean_offline", O.q_clean_offline())
def q_clean_offline(spark, sf):
    ab, co, sw = FX.fixture_lexicons(spark)
    return clean_comments(FX.comments(spark, sf), ab, co, sw, mode="offline")


@query("q_expand_abbrev", O.clean_sql(DOCS_SQL, O.online_text_sql("cmt"), FX.FIXTURE_ABBREVIATIONS, [], []))
def q_expand_abbrev(spark, sf):
    ab, _, _ = FX.fixture_lexicons(spark)
    return clean_comments(FX.comments(spark, sf), abbreviations=ab)


@query("q_stopwords", O.clean_sql(DOCS_SQL, O.online_text_sql("cmt"), [], FX.FIXTURE_STOPWORDS, []))
def q_stopwords(spark, sf):
    _, _, sw = FX.fixture_lexicons(spark)
    return clean_comments(FX.comments(spark, sf), stopwords=sw)


@query("q_segment", O.clean_sql(DOCS_SQL, O.online_text_sql("cmt"), [], [], FX.FIXTURE_COMPOUNDS))
def q_segment(spark, sf):
    _, co, _ = FX.fixture_lexicons(spark)
    return clean_comments(FX.comments(spark, sf), compounds=co)


def _lattice_sql() -> str:
    phrases = [p.replace("_", " ").split() for p in FX.FIXTURE_COMPOUNDS]
    one = lambda p: "SELECT id, pos, " + str(len(p)) + " AS n, " + _q(" ".join(p)) + " AS u FROM (SELECT id, pos, w, " + ", ".join(
        f"lead(w, {k}) OVER (PARTITION BY id ORDER BY pos) AS w{k}" for k in range(1, len(p))) + " FROM toks) WHERE w = " + _q(p[0]) + "".join(
        f" AND w{k} = {_q(w)}" for k, w in enumerate(p) if k)
    parts = ", ".join(_q(w) for w in sorted({w for p in phrases for w in p}))
    return f"""WITH base AS (SELECT doc_id AS id, regexp_replace({O.online_text_sql('text')}, '([^ ])\\.( |$)', '\\1 .\\2', 'g') AS t FROM documents),
    split AS (SELECT id, unnest(string_split(t, ' ')) AS w, generate_subscripts(string_split(t, ' '), 1) AS k FROM base),
    toks AS (SELECT id, w, row_number() OVER (PARTITION BY id ORDER BY k) AS pos FROM split WHERE w <> ''),
    joint AS ({" UNION ALL ".join(one(p) for p in phrases)}),
    ends AS (SELECT id, 0 AS pos, 1 AS n, '' AS u FROM toks WHERE pos = 1 UNION ALL SELECT id, max(pos) + 1, 1, '' FROM toks GROUP BY id),
    units AS (SELECT id, pos, 1 AS n, w AS u FROM toks UNION ALL SELECT * FROM joint UNION ALL SELECT * FROM ends)
    SELECT a.u, b.u AS v, count(*) AS n FROM units a JOIN units b ON b.id = a.id AND b.pos = a.pos + a.n
    WHERE a.n > 1 OR b.n > 1 OR a.u IN ({parts}) OR b.u IN ({parts}) GROUP BY a.u, b.u"""


@query("q_lattice_pairs", _lattice_sql())
def q_lattice_pairs(spark, sf):
    """The counts that segmentation in context learns."""
    _, co, _ = FX.fixture_lexicons(spark)
    return LT.pair_counts(FX.comments(spark, sf), co, "cmt")


@query("q_segment_context")
def q_segment_context(spark, sf):
    """B6 in context, learned from and applied to all documents; tests/test_lattice.py tries every segmentation."""
    _, co, _ = FX.fixture_lexicons(spark)
    return LT.segment(FX.comments(spark, sf), co, text_col="cmt")


@query("q_strip_author", f"""SELECT doc_id AS id,
    regexp_replace(text, {_q(V.AUTHOR_LINE_PATTERN)}, '') AS stripped FROM documents""")
def q_strip_author(spark, sf):
    return FX.comments(spark, sf).select("id", TX.strip_author("cmt").alias("stripped"))


@query("q_denoise", f"""SELECT doc_id AS id, regexp_replace(text, {_q(V.NOISE_PATTERN)}, ' ', 'g') AS denoised
    FROM documents""")
def q_denoise(spark, sf):
    return FX.comments(spark, sf).select("id", TX.denoise("cmt").alias("denoised"))


@query("q_normalise", f"SELECT doc_id AS id, {O.online_text_sql('text')} AS normalised FROM documents")
def q_normalise(spark, sf):
    return FX.comments(spark, sf).select("id", TX.online_text("cmt").alias("normalised"))


@query("q_non_blank", f"""SELECT doc_id AS id FROM documents
    WHERE regexp_replace({O.online_text_sql('text')}, {_q(V.EDGE_WHITESPACE)}, '', 'g') <> ''""")
def q_non_blank(spark, sf):
    return FX.comments(spark, sf).filter(TX.is_non_blank(TX.online_text("cmt"))).select("id")


@query("q_truncate", f"""SELECT doc_id AS id,
    array_to_string(list_filter(string_split({O.online_text_sql('text')}, ' '), lambda x: x <> '')[1:{V.SERVE_MAX_TOKENS}], ' ')
    AS truncated FROM documents""")
def q_truncate(spark, sf):
    return FX.comments(spark, sf).select("id", TX.truncate_tokens(TX.online_text("cmt"), V.SERVE_MAX_TOKENS).alias("truncated"))


@query("q_text_fallback", "SELECT doc_id, coalesce(CAST(text AS VARCHAR), 'No content') AS content FROM documents")
def q_text_fallback(spark, sf):
    d = FX.table(spark, sf, "documents")
    return d.select("doc_id", TX.text_fallback(d, ["cmt", "cmt_processed", "text"]).alias("content"))


@query("q_short_id", """SELECT doc_id, left(sha256(CAST(doc_id AS VARCHAR)), 8) AS short_id,
    count(*) OVER (PARTITION BY left(sha256(CAST(doc_id AS VARCHAR)), 8)) AS n_same FROM documents""")
def q_short_id(spark, sf):
    from pyspark.sql import Window
    d = FX.table(spark, sf, "documents").select("doc_id", TX.short_id("doc_id").alias("short_id"))
    return d.withColumn("n_same", F.count(F.lit(1)).over(Window.partitionBy("short_id")))


@query("q_url_normalise", "SELECT page_id, regexp_replace(url, '://(mbasic|m)\\.', '://www.') AS url FROM pages")
def q_url_normalise(spark, sf):
    return FX.table(spark, sf, "pages").select("page_id", TX.normalise_url("url").alias("url"))


# ------------------------------------------------------------ scores / labels
def _coerce_sql(e: str) -> str:
    x = f"coalesce(try_cast({e} AS DOUBLE), 0)"
    x = f"CASE WHEN isnan({x}) THEN 0 ELSE {x} END"
    return f"CAST(trunc(greatest(0, least(3, {x}))) AS INTEGER)"


@query("q_coerce_levels", f"""SELECT event_id, {_coerce_sql('value')} AS lvl_value,
    {_coerce_sql('props')} AS lvl_props, {_coerce_sql('user_id')} AS lvl_user FROM events""")
def q_coerce_levels(spark, sf):
    ev = FX.table(spark, sf, "events")
    return ev.select("event_id", S.coerce_level("value").alias("lvl_value"),
                     S.coerce_level("props").alias("lvl_props"), S.coerce_level("user_id").alias("lvl_user"))


@query("q_level_names", O.with_fx("fx_scored") + f"""SELECT id,
    {O.level_name_sql('targets[1]')} AS Individual, {O.level_name_sql('targets[2]')} AS "Group",
    {O.level_name_sql('targets[3]')} AS Societal FROM fx_scored""")
def q_level_names(spark, sf):
    sc = SC.severities(FX.logits(spark, sf))
    return sc.select("id", *[S.level_name(F.element_at("targets", i + 1)).alias(t) for i, t in enumerate(V.TARGETS)])


@query("q_softmax", O.with_fx("fx_logits") + """SELECT id,
    list_transform(list_transform(ind, lambda x: exp(x - list_max(ind))), lambda e: round(e / list_sum(list_transform(ind, lambda x: exp(x - list_max(ind)))), 6)) AS probs,
    CAST(list_position(ind, list_max(ind)) - 1 AS INTEGER) AS level,
    round(list_max(list_transform(ind, lambda x: exp(x - list_max(ind)))) / list_sum(list_transform(ind, lambda x: exp(x - list_max(ind)))), 6) AS top_prob
    FROM fx_logits""")
def q_softmax(spark, sf):
    lg = FX.logits(spark, sf)
    p = S.softmax("ind")
    return lg.select("id", F.transform(p, lambda x: F.round(x, 6)).alias("probs"), S.argmax("ind").alias("level"),
                     r6(F.array_max(p)).alias("top_prob"))


@query("q_multi_label", O.with_fx("fx_logits") + f"""SELECT id, {O.bits_sql(O.sigmoid_sql('typ'), '>')} AS bits_serving,
    {O.bits_sql(O.sigmoid_sql('typ'), '>=')} AS bits_eval FROM fx_logits""")
def q_multi_label(spark, sf):
    lg = FX.logits(spark, sf)
    pr = S.sigmoid("typ")
    return lg.select("id", S.encode_bits(S.threshold(pr, strict=True)).alias("bits_serving"),
                     S.encode_bits(S.threshold(pr, strict=False)).alias("bits_eval"))


@query("q_is_hate", O.with_fx("fx_scored") + "SELECT id, list_max(targets) >= 2 AS is_hate FROM fx_scored")
def q_is_hate(spark, sf):
    return SC.severities(FX.logits(spark, sf)).select("id", S.is_hate("targets").alias("is_hate"))


@query("q_gate", O.with_fx("fx_scored") + "SELECT id, list_contains(targets, 3) AS gate FROM fx_scored")
def q_gate(spark, sf):
    return SC.severities(FX.logits(spark, sf)).select("id", S.gate("targets").alias("gate"))


@query("q_encode_bits", O.with_fx("fx_logits") + """SELECT id,
    rpad(left(array_to_string(list_transform(truth, lambda b: CAST(b AS VARCHAR)), ''), 19), 19, '0') AS truth_bits,
    rpad(left(array_to_string(list_transform(truth[1:7], lambda b: CAST(b AS VARCHAR)), ''), 19), 19, '0') AS short_bits
    FROM fx_logits""")
def q_encode_bits(spark, sf):
    lg = FX.logits(spark, sf)
    return lg.select("id", S.encode_bits("truth").alias("truth_bits"),
                     S.encode_bits(F.slice("truth", 1, 7)).alias("short_bits"))


@query("q_decode_bits", O.with_fx("fx_logits") + f"""SELECT id, {O.decode_sql(O.bits_sql(O.sigmoid_sql('typ')))} AS types,
    {O.decode_sql(O.bits_sql(O.sigmoid_sql('typ')) + " || '111'")} AS types_extra FROM fx_logits""")
def q_decode_bits(spark, sf):
    lg = FX.logits(spark, sf).withColumn("b", S.encode_bits(S.threshold(S.sigmoid("typ"))))
    return lg.select("id", S.decode_bits("b").alias("types"), S.decode_bits(F.concat("b", F.lit("111"))).alias("types_extra"))


@query("q_cascade", O.with_fx("fx_log") + """SELECT id, targets, type_bits, Individual, "Group", Societal,
    type_attack, is_hate FROM fx_log""")
def q_cascade(spark, sf):
    return SC.cascade(FX.logits(spark, sf), keep=["id"])


@query("q_attach_scores", O.with_fx("fx_log") + """SELECT l.id, coalesce(d.text, '') AS cmt, l.is_hate
    FROM fx_log l LEFT JOIN documents d ON d.doc_id = l.id""")
def q_attach_scores(spark, sf):
    scores = SC.cascade(FX.logits(spark, sf), keep=["id"]).select("id", "is_hate")
    return SC.attach_scores(FX.comments(spark, sf), scores).select("id", "cmt", "is_hate")


def _tags_sql() -> str:
    names = f"list_filter({O.NAMES_SQL}, lambda n, i: truth[i] = 1)"
    return O.with_fx("fx_logits") + f""", fx_tags AS (SELECT id, array_to_string(CASE WHEN id % 7 = 0
        THEN list_append({names}, 'Unknown Label') ELSE {names} END, ', ') AS attack_type FROM fx_logits)
        , split AS (SELECT id, list_filter(list_transform(string_split(coalesce(attack_type, ''), ','), lambda x: trim(x)),
            lambda x: x <> '') AS tags FROM fx_tags)
        """


@query("q_split_tags", _tags_sql() + "SELECT id, tags FROM split")
def q_split_tags(spark, sf):
    return FX.tags(spark, sf).select("id", S.split_tags("attack_type").alias("tags"))


@query("q_one_hot", _tags_sql() + f"""SELECT id, list_transform({O.NAMES_SQL}, lambda n: CAST(list_contains(tags, n) AS INTEGER)) AS bits
    FROM split""")
def q_one_hot(spark, sf):
    t = FX.tags(spark, sf).select("id", S.split_tags("attack_type").alias("tags"))
    return t.select("id", S.one_hot("tags").alias("bits"))


@query("q_valid_labels", _tags_sql() + f"""SELECT count(*) AS n_rows,
    count(*) FILTER (WHERE len(list_intersect(tags, {O.NAMES_SQL})) > 0) AS kept,
    count(*) FILTER (WHERE len(tags) = 0) AS skipped_blank,
    count(*) FILTER (WHERE len(tags) > 0 AND len(list_intersect(tags, {O.NAMES_SQL})) = 0) AS skipped_nomatch
    FROM split""")
def q_valid_labels(spark, sf):
    t = FX.tags(spark, sf).select(S.split_tags("attack_type").alias("tags"))
    ok = S.has_known_label("tags")
    return t.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(ok).alias("kept"),
                 F.count_if(F.size("tags") == 0).alias("skipped_blank"),
                 F.count_if((F.size("tags") > 0) & ~ok).alias("skipped_nomatch"))


# ---------------------------------------------------------------- monitoring
@query("q_kpis", O.with_fx("fx_monitor") + """SELECT count(*) AS total, count(*) FILTER (WHERE is_hate) AS toxic,
    count(*) - count(*) FILTER (WHERE is_hate) AS clean,
    round(CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE is_hate) AS DOUBLE) * 100.0 / count(*) ELSE 0 END, 6)
    AS toxic_ratio FROM fx_monitor""")
def q_kpis(spark, sf):
    return MO.kpis(FX.monitor_log(spark, sf)).withColumn("toxic_ratio", r6("toxic_ratio"))


_TYPE_COUNTS_SQL = "tc AS (SELECT t AS type_attack, count(*) AS n FROM fx_monitor, unnest(type_attack) AS u(t) GROUP BY t)"


@query("q_type_counts", O.with_fx("fx_monitor") + ", " + _TYPE_COUNTS_SQL + " SELECT type_attack, n FROM tc")
def q_type_counts(spark, sf):
    return MO.type_counts(FX.monitor_log(spark, sf))


@query("q_top_type", O.with_fx("fx_monitor") + ", " + _TYPE_COUNTS_SQL + """ SELECT
    coalesce((SELECT type_attack FROM tc ORDER BY n DESC, type_attack LIMIT 1), 'N/A') AS top_type,
    coalesce((SELECT max(n) FROM tc), 0) AS n""")
def q_top_type(spark, sf):
    return MO.top_type(FX.monitor_log(spark, sf))


@query("q_target_counts", O.with_fx("fx_monitor") + " " + " UNION ALL ".join(
    f"""SELECT '{t}' AS target, count(*) FILTER (WHERE "{t}" IN ('Offensive', 'Hate')) AS n FROM fx_monitor"""
    for t in V.TARGETS))
def q_target_counts(spark, sf):
    return MO.target_counts(FX.monitor_log(spark, sf))


def _bucket_sql(us: int, col: str = "timestamp") -> str:
    return f"make_timestamp(CAST(floor(epoch_us({col}) / {us}) * {us} AS BIGINT))"


@query("q_trend", O.with_fx("fx_flags") + f"""SELECT {_bucket_sql(3600 * 10**6)} AS time_block,
    CAST(sum(CAST(is_hate AS INTEGER)) AS BIGINT) AS toxic_count FROM fx_flags GROUP BY 1""")
def q_trend(spark, sf):
    return MO.trend(FX.flags(spark, sf), block="1 hour")


@query("q_trend_monitor", O.with_fx("fx_monitor") + f"""SELECT {_bucket_sql(5 * 10**6)} AS time_block,
    CAST(sum(CAST(is_hate AS INTEGER)) AS BIGINT) AS toxic_count FROM fx_monitor GROUP BY 1""")
def q_trend_monitor(spark, sf):
    return MO.trend(FX.monitor_log(spark, sf))


# Fixture parameters: events are sparse (one per ~4 min), so the alert runs
# hour-scale: 1-hour window, rate per hour, alert above 5, baseline 2.
_ALERT = dict(window_seconds=3600, rate_unit_seconds=3600, baseline=V.ALERT_BASELINE, threshold=V.ALERT_THRESHOLD)


@query("q_burst_alert", O.with_fx("fx_flags") + """, per_ts AS (SELECT timestamp AS ts,
        sum(CAST(is_hate AS BIGINT)) AS toxic_at FROM fx_flags GROUP BY 1),
    win AS (SELECT ts, CAST(sum(toxic_at) OVER (ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECONDS PRECEDING
        AND CURRENT ROW) AS BIGINT) AS toxic_in_window FROM per_ts),
    r AS (SELECT ts, toxic_in_window, toxic_in_window / 1.0::DOUBLE AS rate FROM win)
    SELECT ts, toxic_in_window, round(rate, 6) AS rate, rate > 5.0 AS is_alert,
        round(CASE WHEN rate > 5.0 THEN rate ELSE 0 END, 6) AS velocity,
        round(CASE WHEN rate > 5.0 THEN (rate - 2.0) / 2.0 * 100.0 ELSE 0 END, 6) AS increase_pct FROM r""")
def q_burst_alert(spark, sf):
    out = MO.burst_alert(FX.flags(spark, sf), **_ALERT)
    return out.select("ts", "toxic_in_window", r6("rate").alias("rate"), "is_alert", r6("velocity").alias("velocity"),
                      r6("increase_pct").alias("increase_pct"))


@query("q_sliding_alert", O.with_fx("fx_flags") + """, starts AS (SELECT f.*,
        (floor(epoch_us(timestamp) / 900000000) - k) * 900000000 AS s FROM fx_flags f, range(0, 4) r(k)),
    agg AS (SELECT s, sum(CAST(is_hate AS BIGINT)) AS toxic FROM starts
        WHERE epoch_us(timestamp) < s + 3600000000 GROUP BY s)
    SELECT make_timestamp(CAST(s AS BIGINT)) AS window_start, make_timestamp(CAST(s + 3600000000 AS BIGINT)) AS window_end,
        CAST(toxic AS BIGINT) AS toxic, round(toxic / 1.0::DOUBLE, 6) AS rate FROM agg WHERE toxic / 1.0::DOUBLE > 5.0""")
def q_sliding_alert(spark, sf):
    out = MO.sliding_alert(FX.flags(spark, sf), window="1 hour", slide="15 minutes", window_seconds=3600,
                           rate_unit_seconds=3600, threshold=V.ALERT_THRESHOLD)
    return out.withColumn("rate", r6("rate"))


@query("q_recent", O.with_fx("fx_monitor") + """SELECT id, timestamp, cmt, cmt_processed, type_attack, Individual,
    "Group", Societal FROM fx_monitor ORDER BY timestamp DESC, id LIMIT 50""")
def q_recent(spark, sf):
    return MO.recent(FX.monitor_log(spark, sf))


@query("q_keep_last", """SELECT user_id, event_id, ts, event_type, value, props FROM (SELECT *,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def q_keep_last(spark, sf):
    ev = FX.table(spark, sf, "events")
    return MO.keep_last_agg(ev, "user_id", ["ts", "event_id"]).select(
        "user_id", "event_id", "ts", "event_type", "value", "props")


_MARK = "2024-01-15 00:00:00"


@query("q_incremental_read", O.with_fx("fx_flags") + f"""SELECT id, timestamp, is_hate FROM fx_flags
    WHERE timestamp > TIMESTAMP '{_MARK}' OR (timestamp = TIMESTAMP '{_MARK}' AND id > 0)""")
def q_incremental_read(spark, sf):
    return MO.incremental_read(FX.flags(spark, sf), _MARK, after_id=0).select("id", "timestamp", "is_hate")


@query("q_high_water_mark", O.with_fx("fx_flags") + f"""SELECT timestamp AS ts, id FROM fx_flags
    WHERE timestamp > TIMESTAMP '{_MARK}' ORDER BY timestamp DESC, id DESC LIMIT 1""")
def q_high_water_mark(spark, sf):
    return MO.high_water_mark(MO.incremental_read(FX.flags(spark, sf), _MARK, strict_ts_only=True))


@query("q_union_increment", O.with_fx("fx_monitor") + """SELECT id, timestamp, is_hate, Individual FROM fx_monitor
    UNION ALL BY NAME SELECT event_id AS id, CAST(ts AS TIMESTAMP) AS timestamp, event_type = 'error' AS is_hate,
    event_type FROM events""")
def q_union_increment(spark, sf):
    acc = FX.monitor_log(spark, sf).select("id", "timestamp", "is_hate", "Individual")
    ev = FX.table(spark, sf, "events")
    inc = ev.select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("timestamp"),
                    (F.col("event_type") == "error").alias("is_hate"), "event_type")
    return MO.union_increment(acc, inc)


@query("q_display_time", O.with_fx("fx_flags") + "SELECT id, timestamp + INTERVAL 7 HOUR AS display_ts FROM fx_flags")
def q_display_time(spark, sf):
    return FX.flags(spark, sf).select("id", MO.display_time("timestamp").alias("display_ts"))


# ------------------------------------------------------------------- metrics
_TASKS = {"Individual": ("y_ind", "p_ind"), "Group": ("y_grp", "p_grp"), "Societal": ("y_soc", "p_soc")}


def _with_preds(spark, sf):
    lg = FX.logits(spark, sf)
    return lg.select("*", S.argmax("ind").alias("p_ind"), S.argmax("grp").alias("p_grp"), S.argmax("soc").alias("p_soc"),
                     S.sigmoid("typ").alias("probs")).withColumn("pred", S.threshold("probs", strict=False))


_PRED_SQL = O.with_fx("fx_logits") + f""", fx_pred AS (SELECT *, {O.argmax_sql('ind')} AS p_ind, {O.argmax_sql('grp')} AS p_grp,
    {O.argmax_sql('soc')} AS p_soc, {O.sigmoid_sql('typ')} AS probs,
    list_transform({O.sigmoid_sql('typ')}, lambda p: CASE WHEN p >= 0.3::DOUBLE THEN 1 ELSE 0 END) AS pred FROM fx_logits),
    long AS (SELECT id, unnest(truth) AS y, unnest(pred) AS p, generate_subscripts(truth, 1) - 1 AS idx FROM fx_pred)
"""


def _rnd(df, cols):
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("q_accuracy", _PRED_SQL + " " + " UNION ALL ".join(
    f"SELECT '{t}' AS task, round(avg(CAST({y} = {p} AS DOUBLE)), 6) AS accuracy FROM fx_pred"
    for t, (y, p) in _TASKS.items()))
def q_accuracy(spark, sf):
    return _rnd(M.accuracy(_with_preds(spark, sf), _TASKS), ["accuracy"])


def _div_sql(a, b):
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


@query("q_class_report", _PRED_SQL + ", preds AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS task, CAST({y} AS VARCHAR) AS y, CAST({p} AS VARCHAR) AS p FROM fx_pred"
    for t, (y, p) in _TASKS.items()) + f"""),
    conf AS (SELECT task, y, p, count(*) AS n FROM preds GROUP BY ALL),
    bt AS (SELECT task, y AS label, sum(n) AS support, sum(CASE WHEN y = p THEN n ELSE 0 END) AS tp FROM conf GROUP BY ALL),
    bp AS (SELECT task, p AS label, sum(n) AS predicted FROM conf GROUP BY ALL),
    per AS (SELECT coalesce(bt.task, bp.task) AS task, coalesce(bt.label, bp.label) AS label,
        coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted
        FROM bt FULL JOIN bp ON bt.task = bp.task AND bt.label = bp.label),
    per2 AS (SELECT task, label, {_div_sql('tp', 'predicted')} AS precision, {_div_sql('tp', 'support')} AS recall,
        {_div_sql('2 * tp', 'predicted + support')} AS f1, support, tp FROM per),
    tot AS (SELECT task, sum(support) AS n, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
        sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM per2 GROUP BY task),
    allrows AS (
        SELECT task, label, precision, recall, f1, support FROM per2
        UNION ALL SELECT task, 'accuracy', NULL, NULL, {_div_sql('tp', 'n')}, n FROM tot
        UNION ALL SELECT task, 'macro avg', mp, mr, mf, n FROM tot
        UNION ALL SELECT task, 'weighted avg', {_div_sql('wp', 'n')}, {_div_sql('wr', 'n')}, {_div_sql('wf', 'n')}, n FROM tot)
    SELECT task, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
        CAST(support AS BIGINT) AS support FROM allrows""")
def q_class_report(spark, sf):
    return _rnd(M.class_report(_with_preds(spark, sf), _TASKS), ["precision", "recall", "f1"])


@query("q_multilabel_metrics", _PRED_SQL + f""", conf AS (SELECT idx, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp,
        count(*) FILTER (WHERE y = 0 AND p = 1) AS fp, count(*) FILTER (WHERE y = 1 AND p = 0) AS fn FROM long GROUP BY idx)
    SELECT round({_div_sql('2 * sum(tp)', '2 * sum(tp) + sum(fp) + sum(fn)')}, 6) AS f1_micro,
        round(sum({_div_sql('2 * tp', '2 * tp + fp + fn')}) / 19, 6) AS f1_macro,
        round({_div_sql('sum(fp) + sum(fn)', '(SELECT count(*) FROM fx_logits) * 19')}, 6) AS hamming_loss FROM conf""")
def q_multilabel_metrics(spark, sf):
    return _rnd(M.multilabel_metrics(_with_preds(spark, sf)), ["f1_micro", "f1_macro", "hamming_loss"])


@query("q_multilabel_report", _PRED_SQL + f""", conf AS (SELECT idx, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp,
        count(*) FILTER (WHERE y = 0 AND p = 1) AS fp, count(*) FILTER (WHERE y = 1 AND p = 0) AS fn FROM long GROUP BY idx),
    per AS (SELECT {O.NAMES_SQL}[idx + 1] AS label, {_div_sql('tp', 'tp + fp')} AS precision,
        {_div_sql('tp', 'tp + fn')} AS recall, {_div_sql('2 * tp', '2 * tp + fp + fn')} AS f1, tp + fn AS support,
        tp, fp, fn FROM conf),
    tot AS (SELECT sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, sum(support) AS s, avg(precision) AS mp,
        avg(recall) AS mr, avg(f1) AS mf, sum(precision * support) AS wp, sum(recall * support) AS wr,
        sum(f1 * support) AS wf FROM per),
    rowc AS (SELECT id, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
        count(*) FILTER (WHERE y = 1 AND p = 0) AS fn FROM long GROUP BY id),
    allrows AS (
        SELECT label, precision, recall, f1, support FROM per
        UNION ALL SELECT 'micro avg', {_div_sql('tp', 'tp + fp')}, {_div_sql('tp', 'tp + fn')},
            {_div_sql('2 * tp', '2 * tp + fp + fn')}, s FROM tot
        UNION ALL SELECT 'macro avg', mp, mr, mf, s FROM tot
        UNION ALL SELECT 'weighted avg', {_div_sql('wp', 's')}, {_div_sql('wr', 's')}, {_div_sql('wf', 's')}, s FROM tot
        UNION ALL SELECT 'samples avg', avg({_div_sql('tp', 'tp + fp')}), avg({_div_sql('tp', 'tp + fn')}),
            avg({_div_sql('2 * tp', '2 * tp + fp + fn')}), (SELECT s FROM tot) FROM rowc)
    SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
        CAST(support AS BIGINT) AS support FROM allrows""")
def q_multilabel_report(spark, sf):
    return _rnd(M.multilabel_report(_with_preds(spark, sf)), ["precision", "recall", "f1"])


@query("q_threshold_sweep", O.with_fx("fx_logits") + f""", fx_pred AS (SELECT id, truth, {O.sigmoid_sql('typ')} AS probs
        FROM fx_logits),
    long AS (SELECT unnest(truth) AS y, unnest(probs) AS p FROM fx_pred),
    th AS (SELECT CAST(k AS DOUBLE) / 100.0::DOUBLE AS t FROM range({V.SWEEP_FROM}, {V.SWEEP_TO + 1}) r(k)),
    sw AS (SELECT t, count(*) FILTER (WHERE y = 1 AND p >= t) AS tp, count(*) FILTER (WHERE y <> 1 AND p >= t) AS fp,
        count(*) FILTER (WHERE y = 1 AND p < t) AS fn FROM th, long GROUP BY t),
    f AS (SELECT t, {_div_sql('2 * tp', '2 * tp + fp + fn')} AS f1 FROM sw)
    SELECT round(t, 6) AS threshold, round(f1, 6) AS f1_micro, row_number() OVER (ORDER BY f1 DESC, t) = 1 AS is_best,
        f1 > 0.5 AS above_good FROM f""")
def q_threshold_sweep(spark, sf):
    return _rnd(M.threshold_sweep(_with_preds(spark, sf)), ["threshold", "f1_micro"])


def _ce_sql(h: str, y: str) -> str:
    return (f"(list_max({h}) + ln(list_sum(list_transform({h}, lambda x: exp(x - list_max({h}))))) - {h}[{y} + 1])")


@query("q_losses", O.with_fx("fx_logits") + f"""SELECT round(avg({_ce_sql('ind', 'y_ind')} + {_ce_sql('grp', 'y_grp')}
        + {_ce_sql('soc', 'y_soc')}), 6) AS ce_sum,
    round(sum(list_sum(list_transform(typ, lambda x, i: greatest(x, 0) - x * truth[i] + ln(1 + exp(-abs(x))))))
        / sum(len(truth)), 6) AS bce FROM fx_logits""")
def q_losses(spark, sf):
    out = M.losses(FX.logits(spark, sf), {"ind": "y_ind", "grp": "y_grp", "soc": "y_soc"})
    return _rnd(out, ["ce_sum", "bce"])


@query("q_subset_accuracy", _PRED_SQL + """SELECT count(*) FILTER (WHERE truth = pred) AS exact, count(*) AS n,
    round(avg(CAST(truth = pred AS DOUBLE)), 6) AS subset_accuracy FROM fx_pred""")
def q_subset_accuracy(spark, sf):
    return _rnd(M.subset_accuracy(_with_preds(spark, sf)), ["subset_accuracy"])


@query("q_label_distribution", """WITH c AS (SELECT d.doc_id, l.toxic, l.quality, d.source, d.lang FROM documents d
        JOIN labels l ON l.doc_id = d.doc_id),
    long AS (""" + " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS value FROM c" for c in ["toxic", "quality", "source", "lang"]) + """),
    counts AS (SELECT dimension, value, count(*) AS n FROM long GROUP BY ALL)
    SELECT dimension, value, n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY dimension), 6) AS share FROM counts""")
def q_label_distribution(spark, sf):
    corpus = FX.table(spark, sf, "documents").join(FX.table(spark, sf, "labels"), "doc_id")
    return _rnd(M.label_distribution(corpus, ["toxic", "quality", "source", "lang"]), ["share"])


@query("q_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) AS n_rows FROM documents"
    for c in ["doc_id", "text", "lang", "source", "n_chars"]))
def q_profile(spark, sf):
    from ..sources.tables import profile
    return profile(FX.table(spark, sf, "documents"))


# -------------------------------------------------------------------- splits
@query("q_shuffle", "SELECT doc_id FROM documents")
def q_shuffle(spark, sf):
    return SP.shuffle_rows(FX.table(spark, sf, "documents").select("doc_id"), "doc_id")


@query("q_sample_n", """SELECT doc_id FROM documents
    ORDER BY sha256(CAST(doc_id AS VARCHAR) || '|42'), doc_id LIMIT 100""")
def q_sample_n(spark, sf):
    return SP.sample_n(FX.table(spark, sf, "documents").select("doc_id"), 100, "doc_id")


@query("q_split", f"""SELECT doc_id, CASE WHEN left(sha256(CAST(doc_id AS VARCHAR) || '|42'), 4) < '{SP.cut_hex(0.8)}'
    THEN 'train' ELSE 'test' END AS split FROM documents""")
def q_split(spark, sf):
    return SP.split(FX.table(spark, sf, "documents").select("doc_id"), "doc_id")


@query("q_stratified_split", O.with_fx("fx_logits") + """, long AS (SELECT id, unnest(truth) AS y,
        generate_subscripts(truth, 1) - 1 AS idx FROM fx_logits),
    freq AS (SELECT idx, count(*) AS freq FROM long WHERE y = 1 GROUP BY idx),
    rarest AS (SELECT l.id, l.idx FROM long l JOIN freq f ON f.idx = l.idx WHERE l.y = 1
        QUALIFY row_number() OVER (PARTITION BY l.id ORDER BY f.freq, l.idx) = 1),
    strat AS (SELECT x.id, CAST(coalesce(r.idx, -1) AS INTEGER) AS stratum,
        sha256(CAST(x.id AS VARCHAR) || '|42') AS h FROM fx_logits x LEFT JOIN rarest r ON r.id = x.id),
    ranked AS (SELECT id, stratum, CAST(row_number() OVER (PARTITION BY stratum ORDER BY h, id) - 1 AS DOUBLE)
        / count(*) OVER (PARTITION BY stratum) AS pos FROM strat)
    SELECT id, stratum, CASE WHEN pos < 0.8 THEN 'train' WHEN pos < 0.9 THEN 'dev' ELSE 'test' END AS split
    FROM ranked""")
def q_stratified_split(spark, sf):
    return SP.stratified_split(FX.logits(spark, sf).select("id", "truth")).select("id", "stratum", "split")


@query("q_split_drift", REGISTRY["q_stratified_split"][1].replace(
    """SELECT id, stratum, CASE WHEN pos < 0.8 THEN 'train' WHEN pos < 0.9 THEN 'dev' ELSE 'test' END AS split
    FROM ranked""", """, splits AS (SELECT r.id, CASE WHEN pos < 0.8 THEN 'train' WHEN pos < 0.9 THEN 'dev' ELSE 'test' END AS split
        FROM ranked r),
    sl AS (SELECT s.split, unnest(x.truth) AS y, generate_subscripts(x.truth, 1) - 1 AS idx
        FROM splits s JOIN fx_logits x ON x.id = s.id)
    SELECT split, CAST(idx AS INTEGER) AS idx, round(avg(CAST(y AS DOUBLE)), 6) AS share FROM sl GROUP BY split, idx"""))
def q_split_drift(spark, sf):
    s = SP.stratified_split(FX.logits(spark, sf).select("id", "truth"))
    return _rnd(SP.split_drift(s), ["share"])


@query("q_iterative_split", O.with_fx("fx_logits") + """, long AS (SELECT id, unnest(truth) AS y,
        generate_subscripts(truth, 1) - 1 AS idx FROM fx_logits),
    carried AS (SELECT id, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS labels FROM long WHERE y = 1 GROUP BY id),
    sets AS (SELECT x.id, coalesce(c.labels, '') AS label_set FROM fx_logits x LEFT JOIN carried c ON c.id = x.id)
    SELECT id, label_set, count(*) OVER (PARTITION BY label_set) AS set_rows, true AS even FROM sets""")
def q_iterative_split(spark, sf):
    """exact are the label sets and that no set's split is off its share by as many rows as there are splits."""
    s = SP.iterative_split(FX.logits(spark, sf).select("id", "truth"))
    counts = s.groupBy("label_set").agg(F.count(F.lit(1)).alias("set_rows"), *[F.count_if(F.col("split") == k).alias(k) for k in ("train", "dev", "test")])
    off = [F.abs(F.col(k) - share * F.col("set_rows")) < 3 for k, share in (("train", 0.8), ("dev", 0.1), ("test", 0.1))]
    return s.join(counts, "label_set").select("id", "label_set", "set_rows", (off[0] & off[1] & off[2]).alias("even"))


# ---------------------------------------------------------------- collection
# No paragraph or list item of the test pages holds another, so patterns find the same text.
_DROPPED = r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->"
_BLOCK = r"(?is)<{0}\b[^>]*>(.*?)</{0}>"
_PAGE_TEXT = "regexp_replace(b, '<[^>]*>', '', 'g')"
for _ent, _ch in CL._ENTITIES:
    _PAGE_TEXT = f"replace({_PAGE_TEXT}, {_q(_ent)}, {_q(_ch)})"
_PAGE_TEXT = f"regexp_replace({_PAGE_TEXT}, {_q(V.EDGE_WHITESPACE)}, '', 'g')"
_PAGE_HTML = f"regexp_replace(html, {_q(_DROPPED)}, '', 'g')"


@query("q_page_blocks", f"""WITH b0 AS (SELECT regexp_replace(url, '://(mbasic|m)\\.', '://www.') AS url,
        list_concat(regexp_extract_all({_PAGE_HTML}, {_q(_BLOCK.format("p"))}, 1),
                    regexp_extract_all({_PAGE_HTML}, {_q(_BLOCK.format("li"))}, 1)) AS blocks FROM pages),
    b1 AS (SELECT url, unnest(blocks) AS b FROM b0),
    b2 AS (SELECT url, {_PAGE_TEXT} AS cmt FROM b1)
    SELECT DISTINCT url, cmt FROM b2 WHERE cmt <> '' AND cmt NOT IN ({", ".join(_q(p) for p in V.UI_PHRASES)})""")
def q_page_blocks(spark, sf):
    return CL.page_blocks(FX.table(spark, sf, "pages"))


def _nested_threads(spark, sf):
    c = FX.table(spark, sf, "conversations")
    return c.groupBy(F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("url")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("comments"))


@query("q_flatten_threads", """SELECT 'conv/' || CAST(conv_id AS VARCHAR) AS url,
    CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS INTEGER) AS pos, text AS cmt
    FROM conversations QUALIFY coalesce(text <> '', false)""")
def q_flatten_threads(spark, sf):
    return CL.flatten_threads(_nested_threads(spark, sf))


@query("q_first_k", O.with_fx("fx_threads") + """SELECT url, pos, cmt FROM fx_threads
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY pos, cmt) <= 3""")
def q_first_k(spark, sf):
    return CL.first_k(FX.threads(spark, sf), 3)


@query("q_distinct_per_url", O.with_fx("fx_threads") + """SELECT url, count(DISTINCT cmt) AS n_distinct FROM fx_threads
    GROUP BY url""")
def q_distinct_per_url(spark, sf):
    return CL.distinct_per_url(FX.threads(spark, sf))


@query("q_new_per_round", O.with_fx("fx_threads") + """, first_seen AS (SELECT url, cmt, min(pos // 4) AS round
        FROM fx_threads GROUP BY url, cmt)
    SELECT url, round, count(*) AS n_new FROM first_seen GROUP BY url, round""")
def q_new_per_round(spark, sf):
    t = FX.threads(spark, sf).withColumn("round", F.floor(F.col("pos") / 4))
    return CL.new_per_round(t)


# ---------------------------------------------------------- sub-words, accents
_SUBWORD_SQL = f"""WITH toks AS (SELECT doc_id AS id, unnest(l) AS tok, generate_subscripts(l, 1) AS tpos
        FROM (SELECT doc_id, string_split_regex(text, {_q(V.WHITESPACE_RUN)}) AS l FROM documents)),
    pieces0 AS (SELECT id, tpos, regexp_extract_all(tok, '(?s).{{1,3}}') AS pl FROM toks WHERE tok <> ''),
    pieces AS (SELECT id, tpos, unnest(pl) AS piece, generate_subscripts(pl, 1) AS k FROM pieces0),
    sw AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY tpos, k) - 1 AS pos,
        CASE WHEN k = 1 THEN '▁' || piece ELSE piece END AS token FROM pieces),
    sw2 AS (SELECT *, CAST(pos % 4 AS INTEGER) AS tag_idx, starts_with(token, '▁') AS pre FROM sw),
    m1 AS (SELECT *, sum(CAST(pre AS INTEGER)) OVER (PARTITION BY id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS seen FROM sw2),
    m2 AS (SELECT *, sum(CASE WHEN pre OR seen = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY pos
        ROWS UNBOUNDED PRECEDING) AS word_pos FROM m1),
    words AS (SELECT id, CAST(word_pos AS BIGINT) AS word_pos,
        string_agg(CASE WHEN pre THEN substr(token, 2) ELSE token END, '' ORDER BY pos) AS word,
        list_sort(list_distinct(list(tag_idx))) AS tags FROM m2 GROUP BY id, word_pos)
"""


@query("q_merge_subwords", _SUBWORD_SQL + "SELECT id, word_pos, word, tags FROM words")
def q_merge_subwords(spark, sf):
    return TG.merge_subwords(FX.subwords(spark, sf)).select("id", "word_pos", "word", "tags")


_TAG_ROWS = ", ".join(f"({i}, {_q(n.split('-')[0])}, {_q(n.split('-')[1])})" for i, n in FX.FIXTURE_TAGS)


@query("q_apply_tags", _SUBWORD_SQL + f""", tagt AS (SELECT * FROM (VALUES {_TAG_ROWS}) v(tag_idx, raw, accented)
        WHERE raw <> ''),
    hits AS (SELECT m.id, CAST(m.word_pos AS BIGINT) AS word_pos, arg_min(t.raw, m.pos) AS raw,
        arg_min(t.accented, m.pos) AS accented
        FROM m2 m JOIN tagt t ON t.tag_idx = m.tag_idx JOIN words w ON w.id = m.id AND w.word_pos = m.word_pos
        WHERE instr(w.word, t.raw) > 0 GROUP BY ALL)
    SELECT w.id, string_agg(CASE WHEN h.raw IS NULL THEN w.word ELSE replace(w.word, h.raw, h.accented) END, ' '
        ORDER BY w.word_pos) AS text FROM words w LEFT JOIN hits h ON h.id = w.id AND h.word_pos = w.word_pos
    GROUP BY w.id""")
def q_apply_tags(spark, sf):
    words = TG.merge_subwords(FX.subwords(spark, sf))
    return TG.apply_tags(words, FX.fixture_tag_table(spark))


@query("q_restore_accents", f"""WITH base AS (SELECT doc_id AS id, {O.offline_text_sql('text')} AS t FROM documents),
    toks AS (SELECT id, unnest(string_split(t, ' ')) AS w, generate_subscripts(string_split(t, ' '), 1) AS pos FROM base),
    t2 AS (SELECT * FROM toks WHERE w <> ''),
    counts AS (SELECT translate(w, {_q(TG.FOLD_FROM)}, {_q(TG.FOLD_TO)}) AS folded, w AS form, count(*) AS n FROM t2
        WHERE translate(w, {_q(TG.FOLD_FROM)}, {_q(TG.FOLD_TO)}) <> w GROUP BY ALL),
    dic AS (SELECT folded, form AS restored FROM counts
        QUALIFY row_number() OVER (PARTITION BY folded ORDER BY n DESC, form DESC) = 1),
    out AS (SELECT t2.id, string_agg(coalesce(d.restored, t2.w), ' ' ORDER BY t2.pos) AS restored
        FROM t2 LEFT JOIN dic d ON d.folded = t2.w GROUP BY t2.id)
    SELECT b.id, coalesce(o.restored, '') AS restored FROM base b LEFT JOIN out o ON o.id = b.id""")
def q_restore_accents(spark, sf):
    return TG.restore_accents(FX.comments(spark, sf), text_col="cmt")


@query("q_accent_pairs", f"""WITH base AS (SELECT doc_id AS id, {O.offline_text_sql('text')} AS t FROM documents),
    split AS (SELECT id, unnest(string_split(t, ' ')) AS w, generate_subscripts(string_split(t, ' '), 1) AS pos FROM base),
    toks AS (SELECT id, w, pos, row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS from_end FROM split WHERE w <> ''),
    near AS (SELECT lag(w, 1, '') OVER (PARTITION BY id ORDER BY pos) AS a, w AS b FROM toks
        UNION ALL SELECT w, '' FROM toks WHERE from_end = 1),
    known AS (SELECT DISTINCT translate(w, {_q(TG.FOLD_FROM)}, {_q(TG.FOLD_TO)}) AS folded FROM toks
        WHERE translate(w, {_q(TG.FOLD_FROM)}, {_q(TG.FOLD_TO)}) <> w),
    counts AS (SELECT translate(a, {_q(TG.FOLD_FROM)}, {_q(TG.FOLD_TO)}) AS fa,
        translate(b, {_q(TG.FOLD_FROM)}, {_q(TG.FOLD_TO)}) AS fb, a, b, count(*) AS n FROM near GROUP BY ALL)
    SELECT * FROM counts WHERE fa IN (SELECT folded FROM known) OR fb IN (SELECT folded FROM known)""")
def q_accent_pairs(spark, sf):
    """The counts that restoration in context learns."""
    pairs = AC.fit_accents(FX.comments(spark, sf), "cmt").pairs
    return pairs.select("fa", "fb", F.explode("seen").alias("p")).select("fa", "fb", "p.*")


@query("q_restore_context")
def q_restore_context(spark, sf):
    """B25 in context, learned from and applied to all documents; tests/test_accents.py tries every choice of forms."""
    return AC.restore_in_context(FX.comments(spark, sf), text_col="cmt")


# ------------------------------------------------------------------- payload
@query("q_parse_payload", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def q_parse_payload(spark, sf):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return PL.parse_payload(FX.table(spark, sf, "events"), schema, value_col="props", keep=["event_id"])


@query("q_to_payload", """SELECT event_id, to_json({'id': CAST(event_id AS VARCHAR), 'cmt': event_type,
    'user': user_id}) AS payload FROM events""")
def q_to_payload(spark, sf):
    ev = FX.table(spark, sf, "events")
    return ev.select("event_id", PL.to_payload([F.col("event_id").cast("string").alias("id"),
                                                 F.col("event_type").alias("cmt"), F.col("user_id").alias("user")])
                     .alias("payload"))


# ------------------------------------------------------------ files in and out
from ..sources import lexicon as LX  # noqa: E402
from ..sources import tables as TB  # noqa: E402


def _folder(spark, name):
    from . import streams
    return streams.run_dir(spark, name)


@query("q_read_urls", "SELECT url FROM pages WHERE url IS NOT NULL")
def q_read_urls(spark, sf):
    """A5: a URL list with a header and another column, written from the pages' addresses."""
    path = _folder(spark, "urls")
    FX.table(spark, sf, "pages").where("url is not null").select("page_id", "url").write.option("header", True).csv(path)
    return TB.read_urls(spark, path)


@query("q_read_lines", "SELECT url AS word FROM pages WHERE trim(url) <> ''")
def q_read_lines(spark, sf):
    """A line file with blanks around entries and blank lines between them."""
    path = _folder(spark, "lines")
    lines = FX.table(spark, sf, "pages").where("trim(url) <> ''").select(F.explode(F.array(F.concat(F.lit("  "), "url", F.lit("\t ")), F.lit(" \t"), F.lit(""))))
    lines.write.text(path)
    return LX.read_lines(spark, path)


@query("q_append_csv", "SELECT c_custkey AS id, c_name || ', \"' || c_mktsegment || '\"' AS name FROM customer")
def q_append_csv(spark, sf):
    """Two appends to one CSV folder, with commas and quotes in the values, read back."""
    path = _folder(spark, "csv")
    rows = FX.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("name"))
    for k in range(2):
        TB.append_csv(rows.where(F.col("id") % 2 == k), path)
    return spark.read.schema(rows.schema).option("header", True).option("escape", "\\").csv(path)


@query("q_load_lexicon", """SELECT user_id::VARCHAR AS abbr, event_id::VARCHAR AS "full" FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3 DESC, event_id DESC) = 1""")
def q_load_lexicon(spark, sf):
    """A lexicon in three files whose keys repeat: the later line of the later file wins."""
    base = _folder(spark, "lexicon")
    for k in range(3):
        FX.table(spark, sf, "events").where(F.col("event_id") % 3 == k).select(F.col("user_id").alias("abbr"), F.col("event_id").alias("full")) \
            .coalesce(1).sortWithinPartitions("full").write.option("header", True).csv(f"{base}/part{k}")
    return LX.load_lexicon(spark, f"{base}/*")


@query("q_label_vocab", """WITH v AS (SELECT row_number() OVER (ORDER BY name) - 1 AS idx, name FROM (SELECT DISTINCT event_type AS name FROM events))
    SELECT idx::BIGINT AS idx, name, (SELECT count(*) FROM events e WHERE e.event_type = v.name) AS n FROM v""")
def q_label_vocab(spark, sf):
    """The vocabulary of event types, in order, written as a file, read back and counted."""
    path, ev = _folder(spark, "vocab"), FX.table(spark, sf, "events")
    names = [r[0] for r in ev.select("event_type").distinct().orderBy("event_type").collect()]  # a vocabulary
    LX.write_label_vocab(spark, path, names)
    vocab = spark.read.schema("idx long, name string").json(path)
    counts = ev.groupBy(F.col("event_type").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return vocab.join(counts, "name", "left").select("idx", "name", F.coalesce("n", F.lit(0)).alias("n"))


# ----------------------------------------------------------------- streaming
from ..streaming import monitor as SM  # noqa: E402
from ..streaming import session as SS  # noqa: E402
from ..streaming import sinks as SK  # noqa: E402
from . import streams as ST  # noqa: E402


@query("q_stream_trend", O.with_fx("fx_flags") + f"""SELECT {_bucket_sql(3600 * 10**6)} AS time_block,
    CAST(sum(CAST(is_hate AS INTEGER)) AS BIGINT) AS toxic_count FROM fx_flags GROUP BY 1""")
def q_stream_trend(spark, sf):
    """I4: tumbling 1-hour toxic counts from a stream in update mode = the batch trend, the open block included."""
    rows = ST.replay(spark, FX.flags(spark, sf), lambda s: SM.trend_stream(s, ts="timestamp", block="1 hour"),
                     "trend", "timestamp", sink_fn=_upsert)
    return SK.latest(rows, ["time_block"])


def _upsert(stream, out, ckpt):
    return SK.start_upsert_sink(stream, out, ckpt, trigger={"availableNow": True})


@query("q_stream_keep_last", O.with_fx("fx_flags") + """SELECT id, timestamp + INTERVAL 2 DAYS AS timestamp, NOT is_hate AS is_hate FROM fx_flags""")
def q_stream_keep_last(spark, sf):
    """Every event corrected two days later; the last version of each id stays."""
    f = FX.flags(spark, sf)
    late = f.select("id", (F.col("timestamp") + F.expr("INTERVAL 2 DAYS")).alias("timestamp"), (~F.col("is_hate")).alias("is_hate"))
    rows = ST.replay(spark, f.unionByName(late), lambda s: SM.keep_last_stream(s, ts="timestamp"), "keep_last", "timestamp", sink_fn=_upsert)
    return SK.latest(rows, ["id"])


@query("q_current_alert", O.with_fx("fx_flags") + """, n AS (SELECT max(timestamp) AS now FROM fx_flags)
    SELECT now, CAST(count(*) FILTER (is_hate AND timestamp >= now - INTERVAL 1 HOUR) AS BIGINT) AS toxic,
        count(*) FILTER (is_hate AND timestamp >= now - INTERVAL 1 HOUR) / 1.0::DOUBLE AS rate,
        count(*) FILTER (is_hate AND timestamp >= now - INTERVAL 1 HOUR) / 1.0::DOUBLE > 5.0 AS alert
    FROM fx_flags, n GROUP BY now""")
def q_current_alert(spark, sf):
    """The alert state at the newest row: toxic rate of the last hour."""
    return MO.current_alert(FX.flags(spark, sf), window_seconds=3600, rate_unit_seconds=3600)


@query("q_stream_session", O.with_fx("fx_flags") + """, v AS (SELECT id, timestamp, is_hate FROM fx_flags
        UNION ALL SELECT id, timestamp + INTERVAL 2 DAYS, NOT is_hate FROM fx_flags WHERE id % 3 = 0)
    SELECT id, timestamp, is_hate FROM v WHERE timestamp > TIMESTAMP '2024-01-15 00:00:00'
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY timestamp DESC) = 1""")
def q_stream_session(spark, sf):
    """The monitor's session: every third event comes again two days later, corrected; a reset in between."""
    f = FX.flags(spark, sf).withColumn("reset", F.lit(False))
    late = f.where("id % 3 = 0").select("id", (F.col("timestamp") + F.expr("INTERVAL 2 DAYS")).alias("timestamp"), (~F.col("is_hate")).alias("is_hate"), "reset")
    control = f.limit(1).select(F.lit(None).cast(f.schema["id"].dataType).alias("id"), F.lit(_MARK).cast("timestamp").alias("timestamp"),
                                F.lit(None).cast("boolean").alias("is_hate"), F.lit(True).alias("reset"))
    with SS.rocksdb(spark, idle_batches=False):
        rows = ST.replay(spark, f.unionByName(late).unionByName(control), lambda s: SS.keep_last_session(s, ts="timestamp", shards=8),
                         "session", "timestamp", sink_fn=_upsert)
    return SS.session_view(rows, ts="timestamp")


_LIVE_STEP = 900  # seconds


@query("q_live_alert", O.with_fx("fx_flags") + f""", b AS (SELECT (floor(epoch_us(timestamp) / {_LIVE_STEP}000000) + 1)::BIGINT AS b,
        sum(is_hate::BIGINT) AS n FROM fx_flags GROUP BY 1),
    ticks AS (SELECT unnest(generate_series(min(b), max(b) - 1)) AS t FROM b),
    w AS (SELECT t, coalesce(sum(n), 0)::BIGINT AS toxic FROM ticks LEFT JOIN b ON b.b > t - {3600 // _LIVE_STEP} AND b.b <= t GROUP BY t),
    c AS (SELECT *, toxic > 5 AS alert, coalesce(lag(toxic) OVER (ORDER BY t) > 5, false) AS was FROM w)
    SELECT 'all' AS key, make_timestamp(t * {_LIVE_STEP}000000) AS at, alert, toxic, toxic / 1.0::DOUBLE AS rate FROM c WHERE alert <> was""")
def q_live_alert(spark, sf):
    """When the alert goes on and, by timers, off: the last hour's toxic events every 15 minutes, gaps included."""
    with SS.rocksdb(spark):
        return ST.replay(spark, FX.flags(spark, sf), lambda s: SS.live_alert(
            s, ts="timestamp", step=_LIVE_STEP, window_seconds=3600, rate_unit_seconds=3600), "live", "timestamp")


@query("q_stream_dedup", O.with_fx("fx_flags") + "SELECT id, timestamp, is_hate FROM fx_flags")
def q_stream_dedup(spark, sf):
    """Every event delivered again ten days later, so in another micro-batch; first arrival per id within a 31-day watermark."""
    f = FX.flags(spark, sf)
    twice = f.unionByName(f.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 10 DAYS")))
    return ST.replay(spark, twice, lambda s: SM.dedup_ids(s, ts="timestamp", delay="31 days"), "dedup", "timestamp")


@query("q_stream_sliding_alert", O.with_fx("fx_flags") + """, starts AS (SELECT f.*,
        (floor(epoch_us(timestamp) / 900000000) - k) * 900000000 AS s FROM fx_flags f, range(0, 4) r(k)),
    agg AS (SELECT s, sum(CAST(is_hate AS BIGINT)) AS toxic FROM starts
        WHERE epoch_us(timestamp) < s + 3600000000 GROUP BY s)
    SELECT make_timestamp(CAST(s AS BIGINT)) AS window_start, make_timestamp(CAST(s + 3600000000 AS BIGINT)) AS window_end,
        CAST(toxic AS BIGINT) AS toxic, round(toxic / 1.0::DOUBLE, 6) AS rate FROM agg WHERE toxic / 1.0::DOUBLE > 5.0""")
def q_stream_sliding_alert(spark, sf):
    """Sliding 1-hour windows every 15 minutes from a stream in update mode = the batch alert rows, open windows included."""
    def build(s):
        out = SM.sliding_alert_stream(s, ts="timestamp", window="1 hour", slide="15 minutes", window_seconds=3600,
                                      rate_unit_seconds=3600, threshold=V.ALERT_THRESHOLD)
        return out.withColumn("rate", r6("rate"))
    rows = ST.replay(spark, FX.flags(spark, sf), build, "sliding", "timestamp", sink_fn=_upsert)
    return SK.latest(rows, ["window_start", "window_end"])


def _stream_log_source(spark, sf):
    msgs = FX.comments(spark, sf).join(FX.event_times(spark, sf), "id")
    return msgs, FX.document_logits(spark, sf).select("id", "ind", "grp", "soc", "typ")


_CLEAN_LOG_SQL = O.with_fx("fx_log") + ", cl AS (" + O.clean_sql(
    "SELECT doc_id AS id, text AS cmt FROM documents", O.online_text_sql("cmt"),
    FX.FIXTURE_ABBREVIATIONS, FX.FIXTURE_STOPWORDS, FX.FIXTURE_COMPOUNDS) + """)
    SELECT cl.id, cl.cmt, cl.cmt_processed, l.Individual, l."Group", l.Societal, l.type_attack, l.is_hate
    FROM cl JOIN fx_log l ON l.id = cl.id % (SELECT count(*) FROM embeddings)"""


def _log_sink(spark, lg):
    """Clean -> score -> assemble -> idempotent append, as a sink of a replay."""
    lexicons = prepare_lexicons(*FX.fixture_lexicons(spark))

    def per_batch(df):
        cleaned = clean_comments(df.join(lg, "id"), lexicons=lexicons)  # the raw texts are half of what the cleaned ones would be
        scored = SC.cascade(cleaned, keep=["id", "cmt", "cmt_processed", "timestamp"])
        return scored.drop("targets", "type_bits").withColumn("log_date", F.to_date("timestamp"))

    return lambda stream, out, ckpt: SK.start_log_sink(stream, out, ckpt, transform=per_batch, trigger={"availableNow": True},
                                                       partition_col="log_date")


@query("q_stream_log", _CLEAN_LOG_SQL)
def q_stream_log(spark, sf):
    """Messages, each delivered again 40 days later (another batch and log date),
    -> clean -> score -> assemble -> idempotent append, micro-batch by micro-batch."""
    msgs, lg = _stream_log_source(spark, sf)
    twice = F.array("timestamp", F.col("timestamp") + F.expr("INTERVAL 40 DAYS"))
    out = ST.replay(spark, msgs.withColumn("timestamp", F.explode(twice)), lambda s: s, "log", "timestamp", sink_fn=_log_sink(spark, lg), codec="zstd")
    return out.drop("timestamp", "log_date", *SK.OWN)


@query("q_stream_ingest", _CLEAN_LOG_SQL)
def q_stream_ingest(spark, sf):
    """JSON messages, malformed ones among them, through file_source and messages to the log."""
    msgs, lg = _stream_log_source(spark, sf)
    good = msgs.select("timestamp", F.to_json(F.struct("id", "cmt", F.unix_micros("timestamp").alias("at"))).alias("value"))
    bad = msgs.select("timestamp", F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit(', "cmt')).alias("value"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("cmt", T.StringType()), T.StructField("at", T.LongType())])

    def build(raw):
        parsed = PL.parse_payload(raw, schema, value_col="value")
        return parsed.where("id is not null and cmt is not null").select("id", "cmt", F.timestamp_micros("at").alias("timestamp"))

    out = ST.replay(spark, good.unionByName(bad), build, "ingest", "timestamp", sink_fn=_log_sink(spark, lg))
    return out.drop("timestamp", "log_date", *SK.OWN)


@query("q_idempotent_append", O.with_fx("fx_flags") + "SELECT id, timestamp, is_hate FROM fx_flags")
def q_idempotent_append(spark, sf):
    """Every event stored once although each batch repeats a third of the ids of earlier ones, a year later."""
    flags, path = FX.flags(spark, sf), ST.run_dir(spark, "append")
    for k in range(3):
        fresh = flags.where(F.col("id") % 3 == k)
        old = flags.where(F.col("id") % 3 < k).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 YEAR"))
        SK.idempotent_append(fresh.unionByName(old).unionByName(fresh), k, path, count_rows=False)
    return SK.read_log(spark, path)


@query("q_log_two_writers", O.with_fx("fx_flags") + "SELECT id, timestamp, is_hate FROM fx_flags")
def q_log_two_writers(spark, sf):
    """Two streams, each with its own checkpoint and half of the events twice over, write one log; so does a
    third that starts anew with all events: every event is stored once."""
    flags, base = FX.flags(spark, sf), ST.run_dir(spark, "writers")
    for k, rows in enumerate([flags.where("id % 2 = 0"), flags.where("id % 2 = 1"), flags]):
        ST.replay(spark, rows.unionByName(rows), lambda s: s, f"writer{k}", "timestamp",
                  sink_fn=lambda stream, out, ckpt: SK.start_log_sink(stream, f"{base}/log", ckpt, trigger={"availableNow": True}), read=False)
    return SK.read_log(spark, f"{base}/log")


@query("q_clean_shuffled", O.q_clean_online())
def q_clean_shuffled(spark, sf):
    """B7 in the order of the application: wide rows from a join, dealt out for scoring, then cleaned."""
    ab, co, sw = FX.fixture_lexicons(spark)
    wide = FX.comments(spark, sf).join(FX.event_times(spark, sf), "id").withColumn("length", F.length("cmt"))
    return clean_comments(for_scoring(wide, 16), ab, co, sw).select("id", "cmt", "cmt_processed")


# ------------------------------------------------------------------ Spark ML
from ..operators import models as ML  # noqa: E402


def _text_corpus(spark, sf):
    lg = FX.document_logits(spark, sf)
    docs = FX.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return SP.split(docs.join(lg, "id"), "id")


@query("q_fit_levels")
def q_fit_levels(spark, sf):
    """Three severity heads on TF-IDF, evaluated on the hash test split."""
    c = _text_corpus(spark, sf)
    return ML.fit_levels(c.filter("split = 'train'"), c.filter("split = 'test'"),
                         {"p_ind": "y_ind", "p_grp": "y_grp", "p_soc": "y_soc"}, max_iter=20, num_features=1 << 16)


def _handed_over(spark, c):
    """A scorer fitted on the training split, saved and loaded again."""
    path = ST.run_dir(spark, "scorer")
    ML.fit_scorer(c.filter("split = 'train'"), {"ind": "y_ind", "grp": "y_grp", "soc": "y_soc"}, "truth", len(V.TYPE_ATTACK_LABELS),
                  max_iter=5, num_features=1 << 12).save(path)
    return ML.TextScorer.load(spark, path)


@query("q_fit_cascade", f"""SELECT doc_id AS id, true AS levels_known, true AS types_known FROM documents
    WHERE left(sha256(CAST(doc_id AS VARCHAR) || '|42'), 4) >= '{SP.cut_hex(0.8)}'""")
def q_fit_cascade(spark, sf):
    """J3 + J4 -> J2: fit, save, load, score the test split, cascade; exact are its ids and the domains of levels and types."""
    c = _text_corpus(spark, sf)
    scored = _handed_over(spark, c).logits(c.filter("split = 'test'").select("id", "text"))
    log = SC.cascade(scored, keep=["id"])
    known = F.array(*[F.lit(x) for x in V.LEVEL_NAMES.values()])
    names = F.array(*[F.lit(x) for x in V.TYPE_ATTACK_LABELS])
    levels = F.array_contains(known, F.col("Individual")) & F.array_contains(known, F.col("Group")) & F.array_contains(known, F.col("Societal"))
    return log.select("id", levels.alias("levels_known"), (F.size(F.array_except("type_attack", names)) == 0).alias("types_known"))


@query("q_fit_report")
def q_fit_report(spark, sf):
    """J3 -> E9: class report of a handed-over model on the test split."""
    c = _text_corpus(spark, sf)
    scored = _handed_over(spark, c).logits(c.filter("split = 'test'").select("id", "text", "y_ind", "y_grp", "y_soc"))
    pairs = {t: (f"y_{t}", f"p_{t}") for t in ("ind", "grp", "soc")}
    return M.class_report(scored.select("id", *[f"y_{t}" for t in pairs], *[S.argmax(t).alias(f"p_{t}") for t in pairs]), pairs)


@query("q_fit_types")
def q_fit_types(spark, sf):
    """19 binary label classifiers on TF-IDF."""
    c = _text_corpus(spark, sf)
    return ML.fit_types(c.filter("split = 'train'"), c.filter("split = 'test'"), len(V.TYPE_ATTACK_LABELS),
                        max_iter=20, num_features=1 << 16)


@query("q_fit_heads", f"""SELECT doc_id AS id, {len(V.TYPE_ATTACK_LABELS)} AS n_labels, true AS in_domain FROM documents
    WHERE left(sha256(CAST(doc_id AS VARCHAR) || '|42'), 4) >= '{SP.cut_hex(0.8)}'""")
def q_fit_heads(spark, sf):
    """All label heads in one pass per step, stopped early by a tenth of the training rows; exact are ids and domain."""
    c = _text_corpus(spark, sf)
    rest = SP.split(c.filter("split = 'train'").drop("split"), "id", 0.9, seed=43)
    model = HD.fit_heads(rest.filter("split = 'train'"), len(V.TYPE_ATTACK_LABELS), dev=rest.filter("split = 'test'"), max_passes=12)
    out = model.predict(c.filter("split = 'test'"))
    return out.select("id", F.size("probs").alias("n_labels"),
                      (F.forall("probs", lambda p: p.between(0, 1)) & F.forall("pred", lambda p: p.isin(0, 1))).alias("in_domain"))


@query("q_fit_head")
def q_fit_head(spark, sf):
    """10-class head over the fixed embeddings."""
    e = SP.split(FX.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label"), "id")
    return ML.fit_head(e.filter("split = 'train'"), e.filter("split = 'test'"))


@query("q_fit_svm")
def q_fit_svm(spark, sf):
    """TF-IDF + linear SVM on labels.toxic."""
    c = FX.table(spark, sf, "documents").join(FX.table(spark, sf, "labels"), "doc_id") \
        .select(F.col("doc_id").alias("id"), "text", "toxic")
    c = SP.split(c, "id")
    return ML.fit_svm(c.filter("split = 'train'"), c.filter("split = 'test'"))


@query("q_fit_domains", f"""WITH test AS (SELECT doc_id AS id FROM documents
        WHERE left(sha256(CAST(doc_id AS VARCHAR) || '|42'), 4) >= '{SP.cut_hex(0.8)}'),
    vectors AS (SELECT vec_id AS id FROM embeddings
        WHERE left(sha256(CAST(vec_id AS VARCHAR) || '|42'), 4) >= '{SP.cut_hex(0.8)}')
    SELECT 'levels' AS model, id, true AS in_domain FROM test UNION ALL SELECT 'types', id, true FROM test
    UNION ALL SELECT 'svm', t.id, true FROM test t JOIN labels l ON l.doc_id = t.id UNION ALL SELECT 'head', id, true FROM vectors""")
def q_fit_domains(spark, sf):
    """Exact are the rows that each model predicts and that its predictions lie in its domain."""
    level = lambda c: F.col(c).isin(*range(4))
    parts = [
        q_fit_levels(spark, sf).select(F.lit("levels").alias("model"), "id", (level("p_ind") & level("p_grp") & level("p_soc")).alias("in_domain")),
        q_fit_types(spark, sf).select(F.lit("types"), "id", (F.size("probs") == len(V.TYPE_ATTACK_LABELS)) & (F.size("pred") == F.size("probs"))
                                      & F.forall("probs", lambda p: p.between(0, 1)) & F.forall("pred", lambda p: p.isin(0, 1))),
        q_fit_svm(spark, sf).select(F.lit("svm"), "id", F.col("predicted").isin(0, 1)),
        q_fit_head(spark, sf).select(F.lit("head"), "id", F.col("predicted").between(0, F.lit(9))),
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


def _mean_logit_scorer(pdf):
    """A stand-in per-chunk scorer for J1: mean of the type logits per row."""
    import pandas as pd
    return pd.DataFrame({"id": pdf["id"], "score": [float(sum(x) / len(x)) for x in pdf["typ"]],
                         "chunk_rows": len(pdf)})


@query("q_score_with", O.with_fx("fx_logits") + """SELECT id, round(list_avg(typ), 6) AS score FROM fx_logits""")
def q_score_with(spark, sf):
    """Python scoring per chunk of 128 rows through mapInPandas (Arrow batches)."""
    lg = FX.logits(spark, sf).select("id", "typ")
    out = SC.score_with(lg, _mean_logit_scorer, "id long, score double, chunk_rows long", chunk=128)
    return out.select("id", r6("score").alias("score"))
