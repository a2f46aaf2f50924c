"""Language identification by Bayesian evidence fusion.

posterior(l) ~ P(text | l) * P(declared | l) * P(l | suffix) / P(l) * P(l | host)

* text: byte-trigram model of every language that ``MIN_TEXTS`` texts declare, however small its share, fitted on at
  most ``sample_rows`` rows per declared language (chosen by a hash of the text; 256 KB of model each), a thin one
  leaning on all languages together; overlapping trigrams count a third each;
* declared markup language: its reliability is the confusion of declared and text-only
  language over all rows, smoothed towards the overall shares;
* address suffix and host: grouped counts of the text-only language over all rows, host
  shares smoothed towards the registered domain's, those towards the overall shares; a row's
  own vote is taken out of its host's counts.

Only one row per host is joined to the texts (broadcast when proven small, else by host, where
skewed hosts can be split); all other tables are bounded by the number of languages.

A row is rejected (``lang_ok`` false, ``lang_id`` null) if its text has fewer than
``MIN_LETTERS`` letters, if no language reaches ``MIN_POSTERIOR``, or if its trigrams are (given ``FLOOR_LETTERS`` letters) on average more than ``FLOOR`` nats below the best model's
own mean. Defined cases: null and empty texts are rejected; null host, suffix or declaration is
no evidence; a declaration that is no known language counts as "other"; repeated rows are
judged alike; an empty table gives an empty result, a table without declarations rejects
all rows; other columns pass through, the results are named ``lang_*``.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentguard.llm.common import LOWER, PART_BYTES, carried, materialise, own_fields, own_names, read_table, row_slices, shown, text_bytes
from commentguard.sizing import maybe_broadcast

SAMPLE_ROWS = 20_000
MIN_TEXTS = 5  # declared texts that a language needs for a model of its own, whatever its share
LEAN = 200.0  # trigrams that a language borrows from all languages together
_DENSE = 64  # up to so many languages a task counts in a table, beyond them in sorted pieces
MIN_LETTERS = 1
MIN_POSTERIOR = 0.5
FLOOR = 4.0
FLOOR_LETTERS = 200  # shorter texts vary too much for the floor
HOST_WEIGHT = 5.0
SUFFIX_WEIGHT = 20.0
_BUCKETS = 1 << 16
RESULTS = ["lang_id", "lang_ok", "lang_posterior", "lang_best", "lang_letters", "lang_fit"]

# Letters keep their (lower-cased) byte, everything else in ASCII is a blank.
_FOLD = np.array([int(LOWER[b]) if (65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else 32 for b in range(256)], np.uint8)


def _trigrams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of every trigram that is not all blanks, and the letters of each row."""
    low = _FOLD[buf]
    letter = low != 32
    lead = letter & ((low & 0xC0) != 0x80)
    letters = np.diff(np.append(0, np.cumsum(lead))[off])
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), letters
    x = low.astype(np.uint32)
    code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    bucket = (code * np.uint32(2654435769)) >> np.uint32(16)
    use = letter[:-2] | letter[1:-1] | letter[2:]
    for gap in (1, 2):  # no trigram goes over the end of its text
        at = off[1:-1] - gap
        use[at[(at >= 0) & (at < len(use))]] = False
    at = np.flatnonzero(use)
    return bucket[at], np.searchsorted(off, at, "right") - 1, letters


def _count(languages: list[str], dense: int = _DENSE):
    place = {x: j for j, x in enumerate(languages)}

    def batch_of(cell: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], ["cell", "n"])

    def go(batches):
        total = np.zeros(len(languages) * _BUCKETS, np.int64) if len(languages) <= dense else None
        for batch in batches:
            for part in row_slices(batch, "text", PART_BYTES):
                bucket, row, _ = _trigrams(*text_bytes(part.column("text")))
                k = np.array([place[x] for x in part.column("lang").to_pylist()], np.int64)
                cells = k[row] * _BUCKETS + bucket
                if total is None:
                    yield batch_of(*np.unique(cells, return_counts=True))
                else:
                    total += np.bincount(cells, minlength=total.size)
        if total is not None:
            cell = np.flatnonzero(total)
            yield batch_of(cell, total[cell])
    return go


def declared_language(col: F.Column) -> F.Column:
    """Primary subtag in lower case; blank as null."""
    tag = F.lower(F.regexp_extract(F.trim(col), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.when(tag != "", tag)


class Model:
    """languages, log-probabilities [language, bucket] and each language's mean log-probability of its own text."""

    def __init__(self, languages: list[str], logp: np.ndarray, own: np.ndarray):
        self.languages, self.logp, self.own = languages, logp, own


def fit_text_model(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """From (text, declared) rows: counts of a bounded sample per declared language."""
    labelled = rows.where("declared is not null and text is not null")
    # tags have two or three letters, so there is a bounded number of them
    found = labelled.groupBy("declared").count().where(F.col("count") >= MIN_TEXTS).collect()
    languages = sorted(r["declared"] for r in found)
    if not languages:
        return Model([], np.zeros((0, _BUCKETS), np.float32), np.zeros(0))
    rate = F.from_json(F.lit(json.dumps({r["declared"]: min(1.0, sample_rows / r["count"]) for r in found})), "map<string,double>")
    share = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.where(F.col("declared").isin(languages)).where(share < rate[F.col("declared")])
    cells = (sample.select(F.col("declared").alias("lang"), "text").mapInArrow(_count(languages), "cell bigint, n bigint")
             .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    count = np.zeros(len(languages) * _BUCKETS, np.float32)
    count[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    count = count.reshape(len(languages), _BUCKETS)
    # rare buckets, and thin languages as a whole, lean on the shares over all languages
    pooled = (count.sum(0, dtype=float) + 0.5) / (count.sum(dtype=float) + 0.5 * _BUCKETS)
    logp, own = np.empty_like(count), np.empty(len(languages))
    for j, c in enumerate(count):
        c = c.astype(float)
        line = np.log((c + LEAN * pooled) / (c.sum() + LEAN))
        logp[j], own[j] = line, (c * line).sum() / max(c.sum(), 1)
    return Model(languages, logp, own)


def _score(shared, keep: list[str], text: str):
    def go(batches):
        model = shared.value
        k = len(model.languages)
        for batch in batches:
            for part in row_slices(batch, text, PART_BYTES):
                bucket, row, letters = _trigrams(*text_bytes(part.column(text)))
                n = np.bincount(row, minlength=part.num_rows)
                ll = np.stack([np.bincount(row, model.logp[j][bucket], minlength=part.num_rows) for j in range(k)], 1) \
                    if k else np.zeros((part.num_rows, 0))
                best = ll.argmax(1) if k else np.zeros(part.num_rows, np.int64)
                mean = ll[np.arange(len(n)), best] / np.maximum(n, 1) - model.own[best] if k else np.zeros(len(n))
                vote = np.where(n > 0, best, -1) if k else np.full(len(n), -1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, k * len(n) + 1, max(k, 1), dtype=np.int32)) if k else
                                                 pa.array(np.zeros(len(n) + 1, np.int32)), pa.array(ll.ravel() / 3))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + [lists, pa.array(letters.astype(np.int64)), pa.array(mean), pa.array(vote.astype(np.int32))],
                    names=keep + ["lang_ll", "lang_letters", "lang_fit", "lang_vote"])
    return go


def identify(rows: DataFrame, keep: list[str], text: str, declared: F.Column | None = None, host: F.Column | None = None,
             domain: F.Column | None = None, suffix: F.Column | None = None, model: Model | None = None) -> DataFrame:
    """The ``keep`` columns with lang_id (null if rejected), lang_ok, lang_posterior, lang_best, lang_letters and lang_fit."""
    return shown(_identify(rows, keep, text, declared, host, domain, suffix, model), keep, RESULTS)


def _identify(rows: DataFrame, keep: list[str], text: str, declared: F.Column | None, host: F.Column | None,
              domain: F.Column | None, suffix: F.Column | None, model: Model | None) -> DataFrame:
    spark = rows.sparkSession
    none = F.lit(None).cast("string")
    declared, host, domain, suffix = (none if c is None else c for c in (declared, host, domain, suffix))
    own = own_names(keep)
    columns, name = carried(keep, text, "lang_text")
    ready = rows.select(*columns, declared.alias("lang_declared"),
                        F.coalesce(host, F.lit("")).alias("lang_host"), domain.alias("lang_domain"), suffix.alias("lang_suffix"))
    if model is None:
        model = fit_text_model(ready.select(F.col(name).alias("text"), F.col("lang_declared").alias("declared")))
    names, k = model.languages, len(model.languages)
    known = F.when(F.col("lang_declared").isin(names) | F.col("lang_declared").isNull(), F.col("lang_declared")).otherwise("other") \
        if k else none
    ready = ready.withColumn("lang_declared", known)
    cols = [c for c in ready.columns if c != "lang_text"]  # a text that passes stays
    shared = spark.sparkContext.broadcast(model)
    added = T._parse_datatype_string("lang_ll array<double>, lang_letters long, lang_fit double, lang_vote int").fields

    def scored(columns: list[str]) -> DataFrame:
        schema = T.StructType([ready.schema[c] for c in columns] + added)
        return ready.select(*dict.fromkeys([*columns, name])).mapInArrow(_score(shared, columns, name), schema)

    if not k:
        return scored(cols).select(*own, none.alias("lang_id"), F.lit(False).alias("lang_ok"), F.lit(0.0).alias("lang_posterior"),
                                   none.alias("lang_best"), "lang_letters", "lang_fit")
    evidence = ["lang_declared", "lang_host", "lang_domain", "lang_suffix"]
    votes = materialise(scored(evidence).groupBy(*evidence, "lang_vote").count().where("lang_vote >= 0"), "lang-votes")
    # P(declared | language) and the overall shares: bounded by the number of languages
    grid = np.zeros((k, k + 1))
    shares = np.full(k, 1.0)
    place = {x: j for j, x in enumerate([*names, "other"])}
    for r in votes.groupBy("lang_declared", "lang_vote").agg(F.sum("count").alias("n")).collect():
        shares[r["lang_vote"]] += r["n"]
        if r["lang_declared"] is not None:
            grid[r["lang_vote"], place[r["lang_declared"]]] += r["n"]
    shares /= shares.sum()
    base = (grid.sum(0) + 1) / (grid.sum() + k + 1)
    reliable = np.log((grid + 2 * base) / (grid.sum(1, keepdims=True) + 2))

    def array(x) -> F.Column:
        return F.array(*[F.lit(float(v)) for v in x])

    per = lambda key: votes.groupBy(*key).agg(
        F.array(*[F.sum(F.when(F.col("lang_vote") == j, F.col("count")).otherwise(0)).cast("double") for j in range(k)]).alias("n"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    smooth = lambda c, prior, w: F.zip_with(c, prior, lambda n, p: (n + w * p) / (total(c) + w))
    hosts = votes.groupBy("lang_host").agg(F.max("lang_domain").alias("lang_domain"), F.max("lang_suffix").alias("lang_suffix")) \
        .join(per(["lang_host"]).withColumnRenamed("n", "host_n"), "lang_host")
    domains = per(["lang_domain"]).where("lang_domain is not null").withColumnRenamed("n", "domain_n")
    suffixes = per(["lang_suffix"]).where("lang_suffix is not null").withColumnRenamed("n", "suffix_n")
    hosts = hosts.join(domains, "lang_domain", "left").join(suffixes, "lang_suffix", "left")
    p0 = array(shares)
    hosts = hosts.select("lang_host", F.when(F.col("lang_host") != "", F.col("host_n")).alias("host_n"),
                         F.when(F.col("domain_n").isNull(), p0).otherwise(smooth("domain_n", p0, F.lit(HOST_WEIGHT))).alias("domain_p"),
                         F.when(F.col("suffix_n").isNull(), p0).otherwise(smooth("suffix_n", p0, F.lit(SUFFIX_WEIGHT))).alias("suffix_p"))
    hosts = maybe_broadcast(materialise(hosts, "lang-hosts"))

    out = scored(cols).join(hosts, "lang_host", "left")
    zero = array([0.0] * k)
    others = F.transform(F.coalesce("host_n", zero), lambda n, j: F.greatest(n - F.when(j == F.col("lang_vote"), 1.0).otherwise(0.0), F.lit(0.0)))
    out = out.withColumn("lang_own", others)
    prior = smooth("lang_own", F.coalesce("domain_p", p0), F.lit(HOST_WEIGHT))
    out = out.withColumn("lang_prior", prior)
    table = F.from_json(F.lit(json.dumps({d: reliable[:, j].tolist() for d, j in place.items()})), "map<string,array<double>>")
    said = F.coalesce(F.element_at(table, F.col("lang_declared")), zero)
    logs = F.zip_with(F.zip_with("lang_ll", said, lambda a, b: a + b),
                      F.zip_with("lang_prior", F.zip_with(F.coalesce("suffix_p", p0), p0, lambda a, b: F.log(a) - F.log(b)),
                                 lambda a, b: F.log(a) + b), lambda a, b: a + b)
    out = out.withColumn("lang_log", logs).withColumn("lang_top", F.array_max("lang_log"))
    out = out.withColumn("lang_posterior", 1 / F.aggregate("lang_log", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("lang_top"))))
    out = out.withColumn("lang_best", F.element_at(F.array(*[F.lit(x) for x in names]),
                                                   F.array_position("lang_log", F.col("lang_top")).cast("int")))
    ok = (F.col("lang_letters") >= MIN_LETTERS) & (F.col("lang_posterior") >= MIN_POSTERIOR) \
        & ((F.col("lang_fit") >= -FLOOR) | (F.col("lang_letters") < FLOOR_LETTERS))
    return out.select(*own, F.when(ok, F.col("lang_best")).alias("lang_id"), ok.alias("lang_ok"),
                      "lang_posterior", F.when(F.col("lang_letters") > 0, F.col("lang_best")).alias("lang_best"), "lang_letters",
                      "lang_fit")


def visible_text(html: str) -> F.Column:
    """Text of a page without scripts, styles, comments and tags."""
    bare = F.regexp_replace(F.col(html), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&#?\w{1,8};", " ")


def markup_language(html: str) -> F.Column:
    """lang attribute of the html element."""
    return declared_language(F.regexp_extract(F.col(html), r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z][A-Za-z0-9_-]*)", 1))


def url_host(url: str) -> F.Column:
    host = F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def _document_evidence() -> dict:
    """Documents: lang declares, a text that is markup declares for itself, the source is the host."""
    return {"text": "text", "declared": F.coalesce(markup_language("text"), declared_language(F.col("lang"))), "host": F.col("source"),
            "domain": None, "suffix": None, "model": None}


def identify_documents(docs: DataFrame, keep: list[str]) -> DataFrame:
    return identify(docs, keep, **_document_evidence())


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The document rows whose language is accepted, with their own columns."""
    return shown(_identify(docs, docs.columns, **_document_evidence()).where("lang_ok"), docs.columns, [])


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: language of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return identify_documents(docs, ["doc_id", "lang", "source"])


def op9_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over all pages, where markup, address suffix, domain and host speak too."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    host = url_host("url")
    pages = pages.withColumns({"visible": visible_text("html"), "said": markup_language("html"), "host": host})
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    suffix = F.regexp_extract("host", r"\.([^.]+)$", 1)
    return identify(pages, ["page_id", "url", "host", "said"], "visible", F.col("said"), F.col("host"),
                    F.when(domain != "", domain), F.when(suffix != "", suffix))


QUERIES = {"op9_language_id": (op9_language_id, None), "op9_language_id_pages": (op9_language_id_pages, None)}
