"""The registered queries over the operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import (
    chat_trees,
    decontamination,
    exact_dedup,
    fill_middle,
    language,
    lattice_lm,
    line_dedup,
    mixing,
    ngram_join,
    pii,
    secret_scan,
    toxicity,
    vector_codes,
)
from tidemark.llm.rowwise import count_kind, of_kinds, spans_text

QUERIES = {}
ORACLES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id, modulus):
    """Whether the id's remainder is 2; a null id is not held out."""
    remainder = F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus))
    return doc_id.isNotNull() & (remainder == 2)


@query
def op1_pii(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find_pii(docs).select("doc_id", "pii")
    return found.select(
        "doc_id",
        *[count_kind(F.col("pii"), k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(spans_text(of_kinds(F.col("pii"), pii.BASE)), 256).alias("base_sha256"),
        spans_text(F.col("pii")).alias("spans"),
    )


@query
def op8_secrets(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs).select("doc_id", "secrets")
    return found.select(
        "doc_id",
        *[count_kind(F.col("secrets"), k).alias(f"n_{k}") for k in secret_scan.BASE],
        F.sha2(spans_text(of_kinds(F.col("secrets"), secret_scan.BASE)), 256).alias("base_sha256"),
        spans_text(F.col("secrets")).alias("spans"),
    )


@query
def op4_exact_dedup(spark, folder):
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


ORACLES["op4_exact_dedup"] = """
WITH normal AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body
    FROM documents
), grouped AS (
    SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY body
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM normal JOIN grouped USING (body)
"""

# Target shares of the mixture; what is not named shares the rest.
MIXTURE = {"src0": 0.20, "src1": 0.10, "src2": 0.10, "src3": 0.08, "src4": 0.08, "src5": 0.06,
           "src6": 0.06, "src7": 0.04, mixing.REST: 0.28}
MIX_PERIOD, MIX_BLOCK = 100, 16


@query
def op3_mixing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    mixed = mixing.mix_sources(
        docs.withColumn("text", F.lit(None).cast("string")), MIXTURE, MIX_PERIOD, MIX_BLOCK
    )
    return mixed.drop("text")


def _mixing_sql():
    """The same schedule as recursion over the slots of one period."""
    slots = mixing.shares(MIXTURE, MIX_PERIOD)
    values = ", ".join(f"({i}, '{s}', {n})" for i, (s, n) in enumerate(slots.items(), 1))
    named = ", ".join(f"'{s}'" for s in slots if s != mixing.REST)
    return f"""
WITH RECURSIVE shares(number, mix_stream, slots) AS (VALUES {values}),
schedule(slot, done, picked) AS (
    SELECT -1, list_transform(range({len(slots)}), lambda x: 0), 0
    UNION ALL
    SELECT slot + 1, list_transform(done, lambda x, i: CASE WHEN i = chosen THEN x + 1 ELSE x END), chosen
    FROM (
        SELECT slot, done, (
            SELECT arg_min(number, ((done[number] + 1) * {MIX_PERIOD} + slots - 1) // slots * 1000 + number)
            FROM shares
            WHERE done[number] < slots AND done[number] * {MIX_PERIOD} // slots <= slot + 1
        ) AS chosen
        FROM schedule WHERE slot + 1 < {MIX_PERIOD}
    )
), period AS (
    SELECT mix_stream, slots, schedule.slot, done[picked] - 1 AS step
    FROM schedule JOIN shares ON number = picked
), streams AS (
    SELECT doc_id, source,
        CASE WHEN source IN ({named}) THEN source ELSE '{mixing.REST}' END AS mix_stream
    FROM documents
), numbered AS (
    SELECT *, row_number() OVER (
        PARTITION BY mix_stream ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS ordinal
    FROM streams
), placed AS (
    SELECT doc_id, source, n.mix_stream, ordinal // {MIX_BLOCK} AS mix_block,
        ordinal // {MIX_BLOCK} // slots * {MIX_PERIOD} + slot AS mix_slot, ordinal
    FROM numbered n JOIN period p
        ON n.mix_stream = p.mix_stream AND ordinal // {MIX_BLOCK} % slots = step
), ends AS (
    SELECT min(full_blocks // f.slots * {MIX_PERIOD} + slot) AS horizon
    FROM (
        SELECT s.mix_stream, s.slots, (SELECT count(*) FROM streams d
            WHERE d.mix_stream = s.mix_stream) // {MIX_BLOCK} AS full_blocks FROM shares s
    ) f JOIN period p ON f.mix_stream = p.mix_stream AND full_blocks % f.slots = step
)
SELECT doc_id, source, mix_stream, mix_block, mix_slot,
    mix_slot * {MIX_BLOCK} + ordinal % {MIX_BLOCK} AS mix_position,
    mix_slot < horizon AS mix_balanced
FROM placed, ends
"""


ORACLES["op3_mixing"] = _mixing_sql()

# Categories of the chain, in its order, as conditions over ``labels``.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


@query
def op9_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    chain = toxicity.learn_toxicity(docs, table(spark, folder, "labels"), CATEGORIES)
    return toxicity.score_toxicity(docs, chain).drop("text")


@query
def op10_language(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    network = language.fit_language(docs.where(~held_out(F.col("doc_id"), 4)))
    predicted = language.identify_language(docs.select("doc_id", "text"), network)
    return predicted.select(
        "doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "lang_pred", "score"
    )


@query
def op2_ngram_join(spark, folder):
    return ngram_join.similar_components(table(spark, folder, "documents"))


ORACLES["op2_ngram_join"] = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda w: w != '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS grams
    FROM words
), sizes AS (SELECT doc_id, len(grams) AS n FROM sets),
incidence AS (SELECT doc_id, unnest(grams) AS gram FROM sets),
counted AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
    FROM incidence a JOIN incidence b ON a.gram = b.gram AND a.doc_id < b.doc_id
    GROUP BY 1, 2
), links AS (
    SELECT u, v FROM counted JOIN sizes s ON u = s.doc_id JOIN sizes t ON v = t.doc_id
    WHERE 100 * shared >= 90 * (s.n + t.n - shared)
), edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(doc_id, root) AS (
    SELECT doc_id, doc_id FROM sizes
    UNION
    SELECT v, root FROM reach JOIN edges ON u = reach.doc_id
)
SELECT doc_id, n AS n_shingles, min(root) AS component_id
FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""


@query
def op5_line_dedup(spark, folder):
    return line_dedup.line_groups(table(spark, folder, "documents"))


@query
def op6_lattice_lm(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 7)
    scored = lattice_lm.lattice_likelihood(docs, ~out)
    return scored.select(
        "doc_id", out.alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


@query
def op7_decontamination(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontamination.find_leaks(docs, table(spark, folder, "benchmark"))


@query
def op11_chats(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    messages = chat_trees.chained(rows.union(probe), "conv_id", "turn", "role", "text")
    chats = chat_trees.format_chats(messages)
    # Cut once, then read twice: Catalyst keeps projections apart whose result is used again.
    cut = chats.select(
        F.col("root.group").alias("conv_id"),
        F.col("turns").alias("marks"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        chat_trees.turns_of(F.col("formatted")).alias("turns"),
    )
    read = cut.select(
        "conv_id",
        "formatted_chars",
        chat_trees.read_turns(F.col("turns")).alias("turns"),
        F.array_join(chat_trees.read_loss(F.col("turns"), F.col("marks")), "").alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


# Each control string gets one character more; the marks of a role have a fixed length. A role
# beside the three known ones adds its name in the form of a URL.
ORACLES["op11_chats"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, length(text) + len(regexp_extract_all(text,
        '[<\[]\\*((/?INST|/ROLE)\]|ROLE:|/?s>|</?SYS>>)'))
        + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 WHEN 'system' THEN 17
          ELSE 14 + length(url_encode(role)) END AS chars
    FROM turns
), joined AS (
    SELECT conv_id, count(*) AS n_turns, sum(chars) AS formatted_chars,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss
    FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars,
    sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""

PARTS, ENTRIES, ROUNDS = 16, 64, 2


@query
def op12_vector_codes(spark, folder):
    coded, books = vector_codes.vector_codes(
        table(spark, folder, "embeddings"), parts=PARTS, entries=ENTRIES, rounds=ROUNDS
    )
    return vector_codes.with_group_error(coded).select(
        "vec_id", "code", "error", "label_error",
        F.lit(vector_codes.codebooks_digest(books)).alias("codebooks_sha256"),
    )


def _codes_sql():
    """All distances in full, in every round."""
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
    SELECT vec_id, part, min(list_value(d, e)) AS best FROM (
        SELECT p.vec_id, p.part, e,
            CAST(list_sum(list_transform(x, lambda v, i: (v - b.c[i]) * (v - b.c[i]))) AS BIGINT) AS d
        FROM pieces p JOIN b{k} b ON p.part = b.part)
    GROUP BY vec_id, part
)""")
        if k < ROUNDS:
            steps.append(f"""b{k + 1} AS MATERIALIZED (
    SELECT b.part, b.e, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN (
        SELECT part, e, list(s ORDER BY i) AS c FROM (
            SELECT p.part, a.best[2] AS e, i,
                CAST((sum(x[i]) - (sum(x[i]) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS s
            FROM pieces p JOIN a{k} a ON p.vec_id = a.vec_id AND p.part = a.part, range(1, w + 1) r(i)
            GROUP BY ALL)
        GROUP BY part, e) m ON m.part = b.part AND m.e = b.e
)""")
    return f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), pieces AS MATERIALIZED (
    SELECT vec_id, CAST(part AS INTEGER) AS part, len(x) // {PARTS} AS w,
        x[part * (len(x) // {PARTS}) + 1 : (part + 1) * (len(x) // {PARTS})] AS x
    FROM kept, range({PARTS}) r(part)
), b0 AS MATERIALIZED (
    SELECT part, rank - 1 AS e, x AS c FROM (
        SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS rank FROM pieces)
    WHERE rank <= {ENTRIES}
), {", ".join(steps)}, coded AS (
    SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code,
        CAST(sum(best[1]) AS BIGINT) AS error
    FROM a{ROUNDS} GROUP BY vec_id
), books AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS codebooks_sha256
    FROM b{ROUNDS}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    codebooks_sha256
FROM coded JOIN kept USING (vec_id), books
"""


ORACLES["op12_vector_codes"] = _codes_sql()


@query
def op13_fill_middle(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    made = fill_middle.fill_in_middle(docs)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLES["op13_fill_middle"] = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
        list_transform(range(4), lambda i: CAST('0x' || substr(
            sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), CAST(8 * i + 1 AS BIGINT), 8) AS BIGINT)) AS h
    FROM documents
), placed AS (
    SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix
    FROM placed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""
