"""DuckDB oracle SQL for the registered queries (ANSI SQL over the test tables)."""

from __future__ import annotations

from .. import vocab as V
from . import fixtures as FX


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_q(x) if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


def _table(name: str, cols: list[str], rows) -> str:
    """CTE of literal rows; an empty list gives an empty VARCHAR table."""
    if not rows:
        sel = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in cols)
        return f"{name} AS (SELECT {sel} WHERE false)"
    return f"{name} AS (SELECT * FROM (VALUES {_values(rows)}) v({', '.join(cols)}))"


def online_text_sql(c: str) -> str:
    x = f"regexp_replace(coalesce(CAST({c} AS VARCHAR), ''), {_q(V.AUTHOR_LINE_PATTERN)}, '')"
    x = f"regexp_replace({x}, {_q(V.NOISE_PATTERN)}, ' ', 'g')"
    x = f"replace({x}, chr(10), '. ')"
    x = f"lower(regexp_replace({x}, {_q(V.EDGE_WHITESPACE)}, '', 'g'))"
    return f"regexp_replace({x}, {_q(V.WHITESPACE_RUN)}, ' ', 'g')"


def offline_text_sql(c: str) -> str:
    x = f"lower(coalesce(CAST({c} AS VARCHAR), ''))"
    x = f"regexp_replace({x}, {_q(V.EDGE_WHITESPACE)}, '', 'g')"
    return f"regexp_replace({x}, {_q(V.WHITESPACE_RUN)}, ' ', 'g')"


def clean_sql(source: str, text_sql: str, abbreviations, stopwords, compounds, id_col="id", text_col="cmt") -> str:
    """Token plan of the cleaner; greedy compound choice as a recursive CTE.

    ``source`` is a subquery yielding (id_col, text_col); ``text_sql`` maps the
    text column to its normalised form.
    """
    max_n = max([len([s for s in p.replace("_", " ").split(" ") if s]) for p in compounds] + [2])
    leads = " ".join(
        f"WHEN lead(i, {k}) OVER w >= i + n THEN lead(i, {k}) OVER w" for k in range(1, max_n + 1)) or "WHEN false THEN 0"
    return f"""
WITH RECURSIVE
{_table("abbr", ["abbr", "full_form"], abbreviations)},
{_table("stop", ["word"], [(w,) for w in stopwords])},
{_table("comp_in", ["phrase"], [(p,) for p in compounds])},
comp0 AS (SELECT list_filter(string_split(replace(phrase, '_', ' '), ' '), lambda x: x <> '') AS syl FROM comp_in),
compc AS (SELECT DISTINCT syl[1] AS first, len(syl) AS n, array_to_string(syl, ' ') AS key,
                 array_to_string(syl, '_') AS joined FROM comp0 WHERE len(syl) >= 2),
base AS (SELECT {id_col} AS id, {text_col} AS cmt, {text_sql} AS t FROM ({source}) src),
toks AS (SELECT id, unnest(string_split(t, ' ')) AS tok, generate_subscripts(string_split(t, ' '), 1) AS pos FROM base),
expd AS (SELECT toks.id, toks.pos,
                list_filter(string_split_regex(coalesce(a.full_form, toks.tok), {_q(V.WHITESPACE_RUN)}), lambda x: x <> '') AS l
         FROM toks LEFT JOIN abbr a ON a.abbr = toks.tok),
subs AS (SELECT id, pos, unnest(l) AS w0, generate_subscripts(l, 1) AS sub FROM expd),
dots0 AS (SELECT id, pos, sub, CASE WHEN length(w0) > 1 AND suffix(w0, '.') THEN [left(w0, length(w0) - 1), '.']
                               ELSE [w0] END AS l2 FROM subs),
dots AS (SELECT id, pos, sub, unnest(l2) AS w, generate_subscripts(l2, 1) AS k FROM dots0),
words AS (SELECT id, w, row_number() OVER (PARTITION BY id ORDER BY pos, sub, k) AS i FROM dots),
wl AS (SELECT id, list(w ORDER BY i) AS ws FROM words GROUP BY id),
cand AS (SELECT wd.id, wd.i, c.n, c.joined IN (SELECT word FROM stop) AS stop
         FROM words wd JOIN compc c ON c.first = wd.w JOIN wl ON wl.id = wd.id
         WHERE array_to_string(wl.ws[wd.i : wd.i + c.n - 1], ' ') = c.key),
best AS (SELECT id, i, n, stop FROM cand QUALIFY row_number() OVER (PARTITION BY id, i ORDER BY n DESC) = 1),
nxt AS (SELECT id, i, n, stop, CASE {leads} END AS next_i FROM best WINDOW w AS (PARTITION BY id ORDER BY i)),
first_c AS (SELECT id, i, n, stop, next_i FROM nxt QUALIFY row_number() OVER (PARTITION BY id ORDER BY i) = 1),
chain(id, i, n, stop, next_i) AS (
  SELECT id, i, n, stop, next_i FROM first_c
  UNION ALL
  SELECT x.id, x.i, x.n, x.stop, x.next_i FROM chain c JOIN nxt x ON x.id = c.id AND x.i = c.next_i),
covered AS (SELECT id, unnest(range(i, i + n)) AS i FROM chain),
units AS (
  SELECT wd.id, wd.i AS p, wd.w AS word, wd.w IN (SELECT word FROM stop) AS stop FROM words wd
  WHERE NOT EXISTS (SELECT 1 FROM covered cv WHERE cv.id = wd.id AND cv.i = wd.i)
  UNION ALL
  SELECT c.id, c.i, array_to_string(wl.ws[c.i : c.i + c.n - 1], '_'), c.stop FROM chain c JOIN wl ON wl.id = c.id),
proc AS (SELECT id, string_agg(word, ' ' ORDER BY p) AS out FROM units WHERE NOT stop AND word <> '' GROUP BY id)
SELECT b.id, b.cmt, coalesce(p.out, '') AS cmt_processed
FROM base b LEFT JOIN proc p ON p.id = b.id
WHERE coalesce(p.out, '') <> ''"""


def q_clean_online() -> str:
    return clean_sql("SELECT doc_id AS id, text AS cmt FROM documents", online_text_sql("cmt"),
                     FX.FIXTURE_ABBREVIATIONS, FX.FIXTURE_STOPWORDS, FX.FIXTURE_COMPOUNDS)


def q_clean_offline() -> str:
    return clean_sql("SELECT doc_id AS id, text AS cmt FROM documents", offline_text_sql("cmt"),
                     FX.FIXTURE_ABBREVIATIONS, FX.FIXTURE_STOPWORDS, FX.FIXTURE_COMPOUNDS)


NAMES_SQL = "[" + ", ".join(_q(n) for n in V.TYPE_ATTACK_LABELS) + "]"


def _scaled(a: int, b: int, shift: str = "") -> str:
    return f"list_transform(embedding[{a}:{b}], lambda x: CAST(x AS DOUBLE) * 10{shift})"


def level_name_sql(e: str) -> str:
    whens = " ".join(f"WHEN {e} = {k} THEN {_q(n)}" for k, n in V.LEVEL_NAMES.items())
    return f"CASE {whens} ELSE {_q(V.UNKNOWN_LEVEL)} END"


def argmax_sql(c: str) -> str:
    return f"CAST(list_position({c}, list_max({c})) - 1 AS INTEGER)"


def sigmoid_sql(c: str) -> str:
    return f"list_transform({c}, lambda x: 1.0::DOUBLE / (1.0::DOUBLE + exp(-x)))"


def bits_sql(probs: str, op: str = ">", t: str = "0.3") -> str:
    return (f"rpad(left(array_to_string(list_transform({probs}, lambda p: CASE WHEN p {op} {t}::DOUBLE "
            f"THEN '1' ELSE '0' END), ''), 19), 19, '0')")


def decode_sql(bits: str) -> str:
    return f"list_filter({NAMES_SQL}, lambda n, i: substr({bits}, i, 1) = '1')"


FX_SQL = {
    "fx_logits": f"""fx_logits AS (SELECT vec_id AS id, {_scaled(1, 4)} AS ind, {_scaled(5, 8)} AS grp,
        {_scaled(9, 12)} AS soc, {_scaled(13, 31, ' - 2.5')} AS typ,
        list_transform(embedding[33:51], lambda x: CASE WHEN CAST(x AS DOUBLE) > 0.1 THEN 1 ELSE 0 END) AS truth,
        label % 4 AS y_ind, (label + 1) % 4 AS y_grp, (label + 2) % 4 AS y_soc FROM embeddings)""",
    "fx_scored": f"""fx_scored AS (SELECT *, [{argmax_sql('ind')}, {argmax_sql('grp')}, {argmax_sql('soc')}] AS targets
        FROM fx_logits)""",
    "fx_cascade": f"""fx_cascade AS (SELECT *, CASE WHEN list_contains(targets, 3) THEN {bits_sql(sigmoid_sql('typ'))}
        ELSE '' END AS type_bits FROM fx_scored)""",
    "fx_log": f"""fx_log AS (SELECT id, targets, type_bits,
        {level_name_sql('targets[1]')} AS Individual, {level_name_sql('targets[2]')} AS "Group",
        {level_name_sql('targets[3]')} AS Societal,
        CASE WHEN list_max(targets) >= 2 AND type_bits <> '' THEN {decode_sql('type_bits')}
             ELSE CAST([] AS VARCHAR[]) END AS type_attack,
        list_max(targets) >= 2 AS is_hate FROM fx_cascade)""",
    "fx_monitor": f"""fx_monitor AS (SELECT d.doc_id AS id, d.text AS cmt, {online_text_sql('d.text')} AS cmt_processed,
        l.Individual, l."Group", l.Societal, l.type_attack, l.is_hate, CAST(e.ts AS TIMESTAMP) AS timestamp
        FROM documents d JOIN fx_log l ON l.id = d.doc_id % (SELECT count(*) FROM embeddings)
        JOIN events e ON e.event_id = d.doc_id % (SELECT count(*) FROM events))""",
    "fx_flags": """fx_flags AS (SELECT event_id AS id, CAST(ts AS TIMESTAMP) AS timestamp,
        event_type = 'error' AS is_hate FROM events)""",
    "fx_threads": """fx_threads AS (SELECT 'conv/' || CAST(conv_id AS VARCHAR) AS url, turn AS pos, text AS cmt
        FROM conversations)""",
}
_DEPS = {"fx_scored": ["fx_logits"], "fx_cascade": ["fx_scored"], "fx_log": ["fx_cascade"], "fx_monitor": ["fx_log"]}


def with_fx(*names: str) -> str:
    """WITH clause defining the named fixtures and their dependencies, in order."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    return "WITH " + ",\n".join(FX_SQL[n] for n in order) + "\n"
