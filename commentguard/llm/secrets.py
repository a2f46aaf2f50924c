"""Secret scans: fixed patterns and a randomness test battery with false-discovery control.

Base spans come from three patterns (an assignment to a secret-like name, an access key id,
a long hex run). The method adds spans for unnamed tokens (runs of A-Z a-z 0-9 + / _ - of at
least 20 characters) that look drawn at random. A token's encoding is the smallest alphabet
that holds its characters; over that alphabet three tests are run: chi-squared uniformity
(of symbols, and of upper case, lower case, digits and signs), runs above and below the alphabet's middle, and serial correlation of
neighbours. The squared normal scores add up to one statistic, small for random tokens.

How small an ordinary string of that length and encoding gets is measured, not assumed: the
prose of every document is written as identifiers of one encoding and length class (words
joined in capitals, with slashes or dashes, or just the characters that a small alphabet
holds) and put through the same battery. The chance that such a string looks at least as random is the token's
p-value, and within each length class Benjamini-Hochberg keeps the false discoveries at
``rate``. A flagged token must also pass as random in itself (``CRITICAL``).

Two row-local passes over the texts: counts of statistics (a table bounded by its number of
bins), then spans. Nothing is shuffled but those counts.

Defined cases: null counts as the empty text and has no spans; repeated rows are scanned row
by row; an empty table gives an empty result; other columns pass through, the results are
named ``secret_*``. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentguard.llm.common import PART_BYTES, carried, mix64, own_fields, own_names, read_table, row_slices, shown, text_bytes

KINDS = ("assign", "access", "hex", "random")
RATE = 0.01
MIN_TOKEN = 20
CRITICAL = 16.27  # of chi-squared with 3 degrees of freedom, upper 0.1 %
LENGTHS = np.array([20, 24, 32, 48, 64, 96, 128])
BINS = 240
MIN_ORDINARY = 10  # fewer ordinary strings of an encoding and length class say nothing
_WIDTH = 66  # of the largest alphabet

# FIXED VALUES: the base patterns of the contract, over UTF-8 bytes; only the names ignore case.
_NAMES = ["password", "passwd", "secret", "token", "api_?key"]


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = re.compile(("(" + "|".join(map(_any_case, _NAMES)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""").encode())
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")

_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings from the smallest alphabet to the largest; a token is in the first that holds it.
ALPHABETS = {"dec": _DIGIT, "hex": _DIGIT + "abcdef", "HEX": _DIGIT + "ABCDEF", "lower": _LOWER, "upper": _UPPER,
             "base32": _UPPER + "234567", "base62": _UPPER + _LOWER + _DIGIT,
             "base64": _UPPER + _LOWER + _DIGIT + "+/", "base64url": _UPPER + _LOWER + _DIGIT + "-_",
             "mixed": _UPPER + _LOWER + _DIGIT + "+/-_"}
_SIZES = np.array([len(a) for a in ALPHABETS.values()])
_INDEX = np.full((len(ALPHABETS), 256), 255, np.uint8)
for _k, _a in enumerate(ALPHABETS.values()):
    _INDEX[_k, np.frombuffer(_a.encode(), np.uint8)] = np.arange(len(_a))
_IN = _INDEX < 255
_TOKEN = _IN[-1].copy()
_HEX = _IN[1].copy()
_DIGITS = _IN[0].copy()
_LETTER = np.zeros(256, bool)
_LETTER[np.frombuffer((_UPPER + _LOWER).encode(), np.uint8)] = True
# Classes of symbols (upper, lower, digit, sign): of each symbol, and their shares under uniformity.
_KIND = np.full((len(ALPHABETS), 128), 3, np.uint8)
for _k, _a in enumerate(ALPHABETS.values()):
    _KIND[_k, :len(_a)] = [0 if c in _UPPER else 1 if c in _LOWER else 2 if c in _DIGIT else 3 for c in _a]
_SHARE = np.stack([np.bincount(_KIND[k, :n], minlength=4) / n for k, n in enumerate(_SIZES)])
# Sets of encodings that a byte belongs to, as bits, for the inference.
_BITS = (_IN * (1 << np.arange(len(ALPHABETS)))[:, None]).sum(0).astype(np.uint16)


def _runs(mask: np.ndarray, off: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True of at least that length, not going over row offsets."""
    on = np.append(mask, False)
    before = np.append(False, mask)
    edge = np.zeros(len(mask) + 1, bool)
    edge[off] = True
    start, end = np.flatnonzero(on & (~before | edge)), np.flatnonzero(before & (~on | edge))
    keep = end - start >= least
    return start[keep], end[keep]


def _pieces(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all characters of the strings, string by string, and the first place of each."""
    first = np.cumsum(size) - size
    return np.arange(size.sum()) - np.repeat(first, size) + np.repeat(start, size), first


def battery(symbols: np.ndarray, first: np.ndarray, size: np.ndarray, enc: np.ndarray) -> np.ndarray:
    """One statistic per string of symbols (alphabet indexes): sum of the squared scores of the three tests."""
    n, m = len(size), size.astype(float)
    of = np.repeat(np.arange(n), size)
    alpha = _SIZES[enc].astype(float)
    x = symbols.astype(float)
    count = np.bincount(of * _WIDTH + symbols, minlength=n * _WIDTH).reshape(n, _WIDTH)
    chi = alpha / m * (count.astype(float) ** 2).sum(1) - m
    uniform = (chi - alpha + 1) / np.sqrt(2 * (alpha - 1) * (m - 1) / m)  # exact mean and variance, sparse or not
    kind = np.bincount(of * 4 + _KIND[enc[of], symbols], minlength=n * 4).reshape(n, 4)
    want = _SHARE[enc] * m[:, None]
    df = (want > 0).sum(1) - 1
    chi = np.where(want > 0, (kind - want) ** 2 / np.where(want > 0, want, 1), 0).sum(1)
    classes = np.where(df > 0, (chi - df) / np.sqrt(np.maximum(2 * df, 1)), 0)
    uniform = np.maximum(uniform, classes)
    high = x >= (alpha / 2)[of]
    inner = np.ones(len(x), bool)
    inner[first] = False  # pairs end with their string
    change = np.zeros(len(x))
    change[1:] = high[1:] != high[:-1]
    runs = np.bincount(of, change * inner, minlength=n) + 1
    up = np.bincount(of, high, minlength=n)
    mean = 2 * up * (m - up) / m + 1
    var = np.maximum((mean - 1) * (mean - 2) / np.maximum(m - 1, 1), 0)
    run_score = np.where(var > 0, (runs - mean) / np.sqrt(np.where(var > 0, var, 1)), np.sqrt(m))
    mid = x - ((alpha - 1) / 2)[of]
    prod = np.zeros(len(x))
    prod[1:] = mid[1:] * mid[:-1]
    serial = np.bincount(of, prod * inner, minlength=n) / ((alpha ** 2 - 1) / 12 * np.sqrt(np.maximum(m - 1, 1)))
    return np.maximum(uniform, 0) ** 2 + run_score ** 2 + serial ** 2


def _bin(stat: np.ndarray) -> np.ndarray:
    return np.minimum(np.sqrt(stat) * 12, BINS - 1).astype(np.int64)


def _class(size: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTHS, size, "right") - 1


def _tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, end, encoding, statistic) of every candidate token."""
    start, end = _runs(_TOKEN[buf], off, MIN_TOKEN)
    if not len(start):
        return start, end, start, start.astype(float)
    at, first = _pieces(start, end - start)
    common = np.bitwise_and.reduceat(_BITS[buf[at]], first)
    enc = np.argmax((common[:, None] >> np.arange(len(ALPHABETS))) & 1, axis=1)
    return start, end, enc, battery(_INDEX[np.repeat(enc, end - start), buf[at]], first, end - start, enc)


def _ordinary(buf: np.ndarray, off: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(encoding, length class, statistic) of strings that the documents' prose makes, candidate tokens left out.

    A document serves one encoding and length class, chosen by its bytes, so that the whole
    corpus is cut up once.
    """
    size = np.diff(off)
    pre = np.append(0, np.cumsum(buf, dtype=np.uint64))
    pick = mix64(size.astype(np.uint64) * np.uint64(1 << 32) + (pre[off[1:]] - pre[off[:-1]]))
    enc_of = (pick % np.uint64(len(ALPHABETS))).astype(np.int64)
    cls_of = ((pick >> np.uint64(32)) % np.uint64(len(LENGTHS))).astype(np.int64)
    doc = np.repeat(np.arange(len(size)), size)
    letter = _LETTER[buf]
    low = buf | 0x20
    new = np.append(True, ~letter[:-1])
    e = enc_of[doc]
    # Position in the encoding's alphabet: case as in identifiers.
    idx = (low - np.uint8(97)) % np.uint8(26)
    digit = _DIGITS[buf]
    idx = np.where(digit, buf - np.uint8(48), idx)
    code = np.where(e <= 2, np.where(digit, idx, idx + 10), np.where(e <= 5, idx, np.where(new, idx, idx + 26)))
    letter = np.where(e == 0, digit, np.where(e <= 2, digit | (letter & (idx < 6)), letter))
    gap = (e >= 7) & ~letter & np.append(False, letter[:-1])
    code = np.where(gap, np.where(e == 7, 63, 62), code)
    keep = letter | gap
    edge = np.zeros(len(buf) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1
    keep &= np.cumsum(edge[:-1]) == 0
    code, doc = code[keep], doc[keep]
    have = np.bincount(doc, minlength=len(size))
    begin = np.cumsum(have) - have
    cut = LENGTHS[cls_of]
    k = have // cut
    of = np.repeat(np.arange(len(size)), k)
    nth = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
    if not len(of):
        return of, of, of.astype(float)
    at, first = _pieces(begin[of] + nth * cut[of], cut[of])
    return enc_of[of], cls_of[of], battery(code[at], first, cut[of], enc_of[of])


def _count(batches):
    for batch in batches:
        total = np.zeros((2, len(ALPHABETS), len(LENGTHS), BINS), np.int64)
        for part in row_slices(batch, "secret_text", PART_BYTES):
            buf, off = text_bytes(part.column("secret_text"))
            if not len(buf):
                continue
            start, end, enc, stat = _tokens(buf, off)
            np.add.at(total[0], (enc, _class(end - start), _bin(stat)), 1)
            enc, cls, stat = _ordinary(buf, off, start, end)
            np.add.at(total[1], (enc, cls, _bin(stat)), 1)
        which = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(total.ravel()[which])], ["cell", "n"])


def _p_values(plain: np.ndarray) -> np.ndarray:
    """Per bin the chance that an ordinary string's statistic is in it or below.

    The share counted, but no less than the lower tail of a log-normal curve through the counted
    strings (its spread widened for few of them), as the counts say nothing below their least.
    """
    n = plain.sum(axis=2, keepdims=True).astype(float)
    place = np.log(np.arange(BINS) + 0.5)
    mean = (plain * place).sum(axis=2, keepdims=True) / np.maximum(n, 1)
    spread = np.sqrt((plain * (place - mean) ** 2).sum(axis=2, keepdims=True) / np.maximum(n - 1, 1))
    z = (place - mean) / (np.maximum(spread, 0.1) * np.sqrt(1 + 1 / np.maximum(n, 1)))
    tail = np.vectorize(math.erfc)(-z / math.sqrt(2)) / 2
    return np.where(n >= MIN_ORDINARY, np.maximum(tail, np.cumsum(plain, axis=2) / np.maximum(n, 1)), 1.0)


def thresholds(docs: DataFrame, text: str = "text", rate: float = RATE) -> np.ndarray:
    """Per encoding and length class the number of the first bin that is not flagged.

    Counts cover all documents; what reaches the driver is bounded by the number of bins.
    """
    slim = docs.select(F.col(text).alias("secret_text")).where(F.col(text).isNotNull())
    cells = slim.mapInArrow(_count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    total = np.zeros((2, len(ALPHABETS), len(LENGTHS), BINS), np.int64)
    for r in cells:
        total.ravel()[r["cell"]] = r["n"]
    tokens, plain = total
    p = _p_values(plain)
    p[..., np.sqrt(CRITICAL) * 12 < np.arange(BINS)] = 1
    cut = np.zeros(tokens.shape[:2], np.int64)
    for c in range(len(LENGTHS)):  # Benjamini-Hochberg inside a length class
        n, q = tokens[:, c].ravel(), p[:, c].ravel()
        order = np.argsort(q, kind="stable")
        upto = np.cumsum(n[order])
        good = np.flatnonzero((q[order] * n.sum() <= rate * upto) & (n[order] > 0))
        level = q[order][good[-1]] if len(good) else -1.0
        cut[:, c] = (p[:, c] <= level).sum(axis=1)
    return cut


def find_spans(buf: np.ndarray, off: np.ndarray, cut: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Per text its spans as (start byte, kind, end byte), in order."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(off) - 1)]
    data = buf.tobytes()
    signs = np.append(0, np.cumsum((buf == 0x3A) | (buf == 0x3D)))
    for r in np.flatnonzero(signs[off[1:]] > signs[off[:-1]]):
        out[r] += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(data, off[r], off[r + 1]) if m.end(2) - m.start(2) >= 12]
    for m in _ACCESS.finditer(data) if b"AKIA" in data else ():
        # a run that goes on into the next text belongs to each in part
        a, b = m.span()
        while a < b:
            r = int(np.searchsorted(off, a, "right")) - 1
            own = min(b, int(off[r + 1]))
            if data[a:own].startswith(b"AKIA"):
                if own - a >= 18:
                    out[r].append((a, 1, own))
                a = own
            else:
                a = data.find(b"AKIA", a + 1, b)  # the one at a, if any, lies across the texts' border
                a = b if a < 0 else a
    start, end = _runs(_HEX[buf], off, 16)
    for a, b, r in zip(start.tolist(), end.tolist(), (np.searchsorted(off, start, "right") - 1).tolist()):
        out[r].append((a, 2, b))
    start, end, enc, stat = _tokens(buf, off)
    flag = _bin(stat) < cut[enc, _class(end - start)] if len(start) else np.zeros(0, bool)
    for a, b, r in zip(start[flag].tolist(), end[flag].tolist(), (np.searchsorted(off, start[flag], "right") - 1).tolist()):
        if not any(x <= a and b <= y for x, _, y in out[r]):  # what a base span holds is found already
            out[r].append((a, 3, b))
    for spans in out:
        spans.sort()
    return out


def _scan(cut: np.ndarray, keep: list[str], text: str, redact: str | None):
    def go(batches):
        span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
        for batch in batches:
            for part in row_slices(batch, text, PART_BYTES):
                buf, off = text_bytes(part.column(text))
                spans = find_spans(buf, off, cut)
                point = np.append(0, np.cumsum((buf & 0xC0) != 0x80))  # code points before a byte
                base = point[off[:-1]].tolist()
                rows = [[{"start": int(point[a]) - z, "kind": k, "end": int(point[b]) - z} for a, k, b in s] for s, z in zip(spans, base)]
                cols = [part.column(c) for c in keep] + [pa.array(rows, span)]
                if redact is not None:
                    data = buf.tobytes()
                    clean = [_hide(data, int(off[r]), int(off[r + 1]), s, redact.encode()) if s else None for r, s in enumerate(spans)]
                    cols.append(pa.array(clean, pa.string()))
                yield pa.RecordBatch.from_arrays(cols, keep + ["secret_spans"] + ["secret_clean"] * (redact is not None))
    return go


def _hide(data: bytes, lo: int, hi: int, spans: list[tuple[int, int, int]], mark: bytes) -> str:
    out, at = [], lo
    for a, _, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [data[at:a], mark]
        at = b
    return b"".join([*out, data[at:hi]]).decode("utf-8", "replace")


def scan(docs: DataFrame, keep: list[str], text: str = "text", rate: float = RATE, redact: str | None = None) -> DataFrame:
    """The ``keep`` columns of every row with secret_spans, an array of (start, kind number, end) in order;
    with ``redact`` also secret_clean, the text with spans replaced by that mark (null where there is none)."""
    return shown(_spans(docs, keep, text, rate, redact), keep, ["secret_spans"] + ["secret_clean"] * (redact is not None))


def _spans(docs: DataFrame, keep: list[str], text: str, rate: float, redact: str | None) -> DataFrame:
    cut = thresholds(docs, text, rate)
    schema = T.StructType(own_fields(docs, keep) + T._parse_datatype_string(
        "secret_spans array<struct<start:long,kind:int,end:long>>" + ", secret_clean string" * (redact is not None)).fields)
    columns, name = carried(keep, text, "secret_text")
    return docs.select(*columns).mapInArrow(_scan(cut, own_names(keep), name, redact), schema)


def redact_secrets(docs: DataFrame, text: str = "text", length: str | None = "n_chars", rate: float = RATE,
                   mark: str = "[SECRET]") -> DataFrame:
    """All rows with their own columns, secrets in ``text`` replaced by the mark; ``length`` names the
    column of the text's length, which follows."""
    found = _spans(docs, docs.columns, text, rate, mark)
    own = dict(zip(docs.columns, own_names(docs.columns)))
    new = {own[text]: F.coalesce("secret_clean", own[text])}
    if length is not None:
        new[own[length]] = F.when(F.col("secret_clean").isNotNull(), F.length("secret_clean").cast(docs.schema[length].dataType)) \
            .otherwise(F.col(own[length]))
    return shown(found.withColumns(new), docs.columns, [])


def _joined(spans) -> F.Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_find_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: spans of secrets in every document."""
    found = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    number = lambda k: F.size(F.filter("secret_spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
                        F.sha2(_joined(F.filter("secret_spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
                        _joined(F.col("secret_spans")).alias("spans"), number(3).alias("n_random"))


QUERIES = {"op3_find_secrets": (op3_find_secrets, None)}
