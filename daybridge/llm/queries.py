"""Registered queries of the operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybridge.llm import chat, secrets
from daybridge.llm.byte_cnn import fit_quality, score_quality
from daybridge.llm.chat import conversation_records, format_records, masked_text, read_chat
from daybridge.llm.decontaminate import benchmark_hits
from daybridge.llm.near_dup import near_duplicates
from daybridge.llm.packing import pack_documents, with_crc32
from daybridge.llm.pitman_yor import score_texts
from daybridge.llm.quality_rules import fit_weights, quality_rules
from daybridge.llm.secrets import find_secrets, span_text
from daybridge.llm.shipping import shipped
from daybridge.llm.substring_dedup import WINDOW, dedup_substrings
from daybridge.llm.text import doc_bucket
from daybridge.llm.token_counts import count_tokens
from daybridge.llm.token_files import read_tokens, token_digests, write_tokens
from daybridge.llm.turn_repair import DAMAGE_OF, damaged, repair_turns
from daybridge.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, code_text, encode_vectors, with_group_sum
from daybridge.sources.scratch import scratch_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
SEQUENCE_TOKENS = 2048
LM_FOLDS, LM_HELD_OUT = 7, 2
HOLDOUT, KEEP_SCORE = 5, 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), doc_bucket("doc_id", LM_FOLDS) == LM_HELD_OUT)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_rules(docs, fit_weights(docs, trusted))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(doc_bucket("doc_id", HOLDOUT) == 0, F.lit(False))
    model = fit_quality(docs, labels.where(~held_out))
    predicted = (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted")
    return score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", predicted)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=1)
    return token_digests(read_tokens(spark, path))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), WORD_BPE)
    over = (F.col("n_tokens") > SEQUENCE_TOKENS).alias("over_limit")
    return counts.select("doc_id", "n_bytes", "n_tokens", over, "n_chunks")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *(count(k) for k in ("assign", "access", "hex")),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.sort_array(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("bigint").alias("n_entropy"),
    )


# The conversation that the contract adds.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.union(spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string"))
    out = format_records(conversation_records(rows)).select("conv_id", "layout", "formatted", "loss_spans")
    turns = read_chat(F.col("formatted"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = out.withColumns({"turns": turns, "loss": masked_text(F.col("formatted"), F.col("loss_spans"))})
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "layout",
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=0, capacity=SEQUENCE_TOKENS)
    return with_crc32(placed).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_vectors(table(spark, sf_dir, "embeddings"), keep=("label",))
    rows = with_group_sum(coded.rows, "label", "error", "label_error")
    digest = F.lit(coded.books_sha256()).alias("codebooks_sha256")
    return rows.select("vec_id", code_text(F.col("code")).alias("code"), "error", "label_error", digest)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_turns(damaged(table(spark, sf_dir, "conversations")), present=F.col("present"))


OPERATORS = (
    op1_lm_scores,
    op2_benchmark_decontamination,
    op3_quality_rules,
    op4_quality_classifier,
    op5_token_files,
    op6_near_duplicates,
    op7_token_counts,
    op8_secret_scan,
    op9_chat_format,
    op10_best_fit_packing,
    op11_vector_codes,
    op12_substring_dedup,
    op13_turn_repair,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: shipped(f) for f in OPERATORS}


# --- SQL over the same tables, where SQL can express a query -------------------------------------

_PLACED = """
SELECT doc_id, list_transform(range(1, len(m) + 1), lambda i: struct_pack(
         start := CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                  + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT), m := m[i])) AS placed
FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, string_split_regex(t, '{pattern}') AS gaps FROM {table})
"""


def _span_sql(pattern: str, kind: str, rank: int, condition: str = "TRUE", table: str = "d") -> str:
    """Rows (doc_id, start, rank, end, kind) of the matches of a pattern that meet a condition on the match ``m``."""
    placed = _PLACED.format(pattern=pattern.replace("'", "''"), table=table)
    return (
        f"SELECT doc_id, s.start AS b, {rank} AS rank, s.start + length(s.m) AS e, '{kind}' AS kind, s.m AS m "
        f"FROM (SELECT doc_id, unnest(placed) AS s FROM ({placed})) WHERE {condition.replace('$m', 's.m')}"
    )


def _entropy_sql(c: secrets.CharClass, rank: int) -> str:
    needs = " AND ".join(["TRUE", *(f"regexp_matches($m, '{n}')" for n in c.needs)])
    allowed = " AND ".join(f"NOT regexp_matches($m, '{a}')" for a in secrets.ALLOW_LIST)
    candidates = _span_sql(f"[{c.alphabet}]{{{c.window},}}", c.kind, rank, needs, "masked")
    return f"""
SELECT doc_id, b + lo AS b, rank, b + hi + {c.window} AS e, kind FROM (
  SELECT doc_id, b, rank, kind, m, min(w) AS lo, max(w) AS hi,
         substring(m, CAST(min(w) AS INTEGER) + 1, CAST(max(w) - min(w) AS INTEGER) + {c.window}) AS part
  FROM (
    SELECT *, sum(CASE WHEN w - before < {c.window} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, b ORDER BY w) AS part_no
    FROM (
      SELECT *, lag(w) OVER (PARTITION BY doc_id, b ORDER BY w) AS before FROM (
        SELECT doc_id, b, rank, kind, m, unnest(list_filter(range(0, length(m) - {c.window - 1}),
          lambda i: list_entropy(string_split(substring(m, CAST(i AS INTEGER) + 1, {c.window}), '')) >= {c.bits})) AS w
        FROM ({candidates}))))
  GROUP BY doc_id, b, rank, kind, m, part_no
) WHERE {needs.replace("$m", "part")} AND {allowed.replace("$m", "part")}
"""


def _secret_sql() -> str:
    value = f"length(regexp_extract($m, '{secrets.ASSIGN.replace(chr(39), chr(39) * 2)}', 2)) >= {secrets.ASSIGN_VALUE}"
    base = " UNION ALL ".join(
        f"(SELECT doc_id, b, rank, e, kind FROM ({x}))"
        for x in (
            _span_sql(secrets.ASSIGN, "assign", 0, value),
            _span_sql(secrets.ACCESS, "access", 1),
            _span_sql(secrets.HEX, "hex", 2),
        )
    )
    found = " UNION ALL ".join(f"({_entropy_sql(c, 3 + i)})" for i, c in enumerate(secrets.CLASSES))
    # This dialect has neither look-behind nor back references. A path part may follow the slash of the one before, which a
    # match would use up, hence two passes; equal characters are compared one by one, in texts that hold a run of them.
    path = "(^|[^A-Za-z0-9+_-])([a-z]+)/"
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_/"
    n = secrets.EQUAL_RUN
    runs = "|".join([*(f"{x}{{{n}}}" for x in signs), f"[+]{{{n}}}", f"[-]{{{n}}}"])
    equal = (
        f"array_to_string(list_transform(range(1, len(c) + 1), lambda i: CASE WHEN i + {n - 1} <= len(c) "
        f"AND len(list_distinct(c[i:i + {n - 1}])) = 1 AND regexp_matches(c[i], '[{secrets.EQUAL_SIGNS}]') THEN ' ' ELSE c[i] END), '')"
    )
    one = "struct_pack(b := b, rank := rank, e := e, kind := kind)"
    text = lambda x: f"array_to_string(list_transform({x}, lambda s: s.kind || ':' || s.b || ':' || s.e), ',')"
    count = lambda k: f"CAST(len(list_filter(base, lambda s: s.kind = '{k}')) AS BIGINT) AS n_{k}"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
parted AS (SELECT doc_id, regexp_replace(regexp_replace(t, '{path}', '\\1\\2 ', 'g'), '{path}', '\\1\\2 ', 'g') AS t FROM d),
masked AS (
  SELECT doc_id, t FROM parted WHERE NOT regexp_matches(t, '{runs}')
  UNION ALL SELECT doc_id, {equal} AS t FROM (SELECT doc_id, string_split(t, '') AS c FROM parted WHERE regexp_matches(t, '{runs}'))),
base AS (SELECT doc_id, list({one} ORDER BY b, rank, e) AS base FROM ({base}) GROUP BY doc_id),
found AS (SELECT doc_id, list({one} ORDER BY b, rank, e) AS found FROM ({found}) GROUP BY doc_id),
both_ AS (
  SELECT d.doc_id, coalesce(base, []) AS base, list_reduce(
           list_concat([coalesce(base, [])], list_transform(coalesce(found, []), lambda s: [s])),
           lambda a, x: CASE WHEN len(list_filter(a, lambda y: y.b < x[1].e AND x[1].b < y.e)) = 0 THEN list_concat(a, x) ELSE a END) AS kept
  FROM d LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id))
SELECT doc_id, {", ".join(count(k) for k in ("assign", "access", "hex"))}, sha256({text("base")}) AS base_sha256,
       {text("list_sort(kept)")} AS spans, CAST(len(kept) - len(base) AS BIGINT) AS n_entropy
FROM both_
"""


def _chat_sql() -> str:
    marks = len(chat.OPEN) + 1 + len(chat.CLOSE) + 1
    angle = chat.ANGLE.replace("(?=", "(")
    square = chat.SQUARE.replace("(?=", "(")
    escaped = lambda x: (
        f"regexp_replace(regexp_replace(replace({x}, '%', '%25'), '{angle}', '%3C\\1', 'g'), '{square}', '%5B\\1', 'g')"
    )
    probe = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in PROBE)
    speakers = ", ".join(f"'{s}'" for s in chat.SPEAKERS)
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {probe}) AS p(conv_id, turn, role, text)),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text) AS loss,
         CAST(sum({marks} + length(replace({escaped("role")}, chr(10), '%0A')) + length({escaped("text")})) AS BIGINT)
           AS formatted_chars,
         string_agg(role, ',' ORDER BY turn, role, text) AS roles,
         bool_and(length(text) > 0) AS whole, bool_and(role NOT IN ({speakers})) AS plain
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars,
       CASE WHEN roles = 'user,assistant' AND whole THEN 'prompt'
            WHEN roles = 'system,user,assistant' AND whole THEN 'instruction'
            WHEN conv_id % 2 = 1 AND plain THEN 'conversations' ELSE 'messages' END AS layout
FROM g
"""


_NEAR_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u AS a JOIN u AS b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM (
  SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.root) AS component_id
  FROM s JOIN r ON r.id = s.doc_id GROUP BY s.doc_id, len(s.s))
"""


def _codes_sql() -> str:
    xs = [f"x{i}" for i in range(64 // PARTS)]
    part = ", ".join(f"v[(p * {len(xs)}) + {i + 1}] AS {x}" for i, x in enumerate(xs))
    gap = " + ".join(f"(d.{x} - b.{x}) * (d.{x} - b.{x})" for x in xs)
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
d AS MATERIALIZED (SELECT vec_id, label, p, {part} FROM kept, (SELECT unnest(range(0, {PARTS})) AS p)),
b0 AS MATERIALIZED (
  SELECT p, e, {", ".join(xs)}
  FROM d JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {ENTRIES}) USING (vec_id))"""
    ]
    near = (
        "SELECT vec_id, p, any_value(label) AS label, min_by(e, g * 100 + e) AS e, min(g) AS g FROM ("
        f"SELECT d.vec_id, d.label, d.p, b.e, {gap} AS g FROM d JOIN b{{k}} AS b USING (p)) GROUP BY vec_id, p"
    )
    for k in range(ROUNDS):
        mean = ", ".join(
            f"CASE WHEN n IS NULL THEN b.{x} ELSE CAST((s_{x} - ((s_{x} % n) + n) % n) // n AS BIGINT) END AS {x}" for x in xs
        )
        sums = ", ".join(f"CAST(sum({x}) AS BIGINT) AS s_{x}" for x in xs)
        steps.append(f"a{k} AS MATERIALIZED ({near.format(k=k)})")
        steps.append(
            f"b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, {mean} FROM b{k} AS b LEFT JOIN ("
            f"SELECT p, e, CAST(count(*) AS BIGINT) AS n, {sums} FROM a{k} JOIN d USING (vec_id, p) GROUP BY p, e) "
            "AS s ON s.p = b.p AND s.e = b.e)"
        )
    steps.append(f"last AS MATERIALIZED ({near.format(k=ROUNDS)})")
    comma = " || ',' || ".join(xs)
    return f"""
WITH {", ".join(steps)},
coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(g) AS BIGINT) AS error
  FROM last GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg({comma}, ',' ORDER BY p, e)) FROM b{ROUNDS}) AS codebooks_sha256
FROM coded
"""


_REPEATS_SQL = f"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w)),
r AS (SELECT doc_id, i FROM g WHERE h IN (SELECT h FROM g GROUP BY h HAVING count(*) > 1)),
c AS (
  SELECT doc_id, i, x, max(r.i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM w) AS p LEFT JOIN r USING (doc_id, i))
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN (
  SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(x, ' ' ORDER BY i) FILTER (NOT gone) AS k FROM c GROUP BY doc_id
) USING (doc_id)
"""


def _repair_sql() -> str:
    # crc32, a bit at a time; its polynomial is the fixed value 0xEDB88320.
    bits = "list_reduce(list_concat([{0}], range(0, 8)), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    byte = "(xor(c, CAST(b AS BIGINT)) % 256)"
    crc = (
        "xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT))), "
        f"lambda c, b: xor(c // 256, {bits.format(byte)})), 4294967295)"
    )
    # A finish is a text: its cost in ten digits, the edits, a separator that sorts before any letter, and the repaired lines.
    more = lambda v, cost, edit, line: (
        f"lpad(CAST(CAST(substr({v}, 1, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || '{edit}' "
        f"|| replace(substr({v}, 11), chr(1), chr(1) || {line})"
    )
    line = lambda role, text: f"{role} || ':' || {text} || chr(10)"
    due = {0: (2, "'user'"), 1: (2, "'user'"), 2: (3, "'assistant'"), 3: (2, "'user'")}
    may = {0: "role LIKE 's%' OR role LIKE 'u%'", 1: "role LIKE 'u%'", 2: "role LIKE 'a%'", 3: "role LIKE 'u%'"}
    goes = {0: "CASE WHEN role LIKE 's%' THEN v1 ELSE v2 END", 1: "v2", 2: "v3", 3: "v2"}
    cut = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
    row = []
    for s in range(4):
        must = "fault IN ('blank', 'duplicate')"
        given = more(f"v{due[s][0]}", f"1 + {cut}", "R", line(due[s][1], "text"))
        keep = more(f"({goes[s]})", cut, "K", line("role", "text"))
        drop = f"lpad(CAST(CAST(substr(v{s}, 1, 10) AS BIGINT) + 2 AS VARCHAR), 10, '0') || 'D' || substr(v{s}, 11)"
        row.append(f"least({drop}, CASE WHEN {must} THEN '~' ELSE {given} END, CASE WHEN {must} OR NOT ({may[s]}) THEN '~' ELSE {keep} END) AS w{s}")
    ins = lambda v, role: more(v, 5, "I", line(role, "''"))
    end = {2: "0000000005I' || chr(1) || 'assistant:' || chr(10)", 1: "0000000010II' || chr(1) || 'user:' || chr(10) || 'assistant:' || chr(10)"}
    return f"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
dealt AS (SELECT * EXCLUDE (name), {crc} % {DAMAGE_OF} AS action FROM named),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN action = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN action = 1 THEN '' WHEN action = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM dealt, (SELECT unnest([0, 1]) AS copy) WHERE action <> 0 AND (copy = 0 OR action = 3)),
placed AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS role_before FROM rows_
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
faulty AS MATERIALIZED (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (role_before IS NOT NULL AND left(role_before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal,
         max(i) AS n
  FROM faulty GROUP BY conv_id),
dp(conv_id, i, v0, v1, v2, v3) AS (
  SELECT conv_id, n, '0000000000' || chr(1), '{end[1]}, '{end[2]}, '0000000000' || chr(1) FROM figures
  UNION ALL
  SELECT conv_id, i, least(w0, {ins("u2", "'user'")}), least(w1, {ins("u2", "'user'")}), u2, u3
  FROM (
    SELECT *, least(w2, {ins("w3", "'assistant'")}) AS u2, least(w3, {ins("w2", "'user'")}) AS u3 FROM (
      SELECT dp.conv_id, dp.i - 1 AS i, {", ".join(row)}
      FROM dp JOIN faulty AS f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i))),
best AS (SELECT conv_id, v0, strpos(v0, chr(1)) AS p FROM dp WHERE i = 0)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(CAST(substr(v0, 1, 10) AS BIGINT), 0) AS cost, coalesce(substr(v0, 11, p - 11), '') AS audit,
       sha256(coalesce(substr(v0, p + 1, greatest(length(v0) - p - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
LEFT JOIN figures AS f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best AS b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_near_duplicates": _NEAR_SQL,
        "op8_secret_scan": _secret_sql(),
        "op9_chat_format": _chat_sql(),
        "op11_vector_codes": _codes_sql(),
        "op12_substring_dedup": _REPEATS_SQL,
        "op13_turn_repair": _repair_sql(),
    }
