"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format,
    exact_index,
    line_runs,
    near_duplicates,
    neighbour_graph,
    packing,
    periodic_runs,
    prefix_trie,
    token_counts,
    topk_search,
    toxicity,
    tree_bpe,
    warc,
)
from .frames import read_table, staged
from ..session import scratch_path


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    documents = read_table(spark, sf_dir, "documents")
    encoded = tree_bpe.encode(documents, path, keep=["doc_id"])
    ids = F.concat_ws(" ", F.col("token_ids").cast("array<string>"))
    return tree_bpe.decode(encoded, path).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# Characters from which on a line repeated alone counts as a run.
LONG_LINE = 100


def op2_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.remove_repeated_runs(documents, long_line=LONG_LINE).select(
        "doc_id",
        "n_lines",
        "n_removed",
        "longest_repeat",
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op3_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_path(spark, 'archives')}/warc"
    warc.write_archives(read_table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, F.col("vec_id") % 50 == 0)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    weights = toxicity.learn(documents, labels, ~held_out)
    scored = toxicity.score(documents, weights, keep=["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), path)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index_path = scratch_path(spark, "digest-index")
    marked = exact_index.mark_copies(read_table(spark, sf_dir, "documents"), index_path)
    return marked.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.col("digest").alias("text_sha256"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(documents, tokenizer_path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    conversations = read_table(spark, sf_dir, "conversations").select(*extra.columns).union(extra)
    template = chat_format.MarkedTemplate()
    formatted = chat_format.format_conversations(conversations, template)
    return chat_format.read_back(formatted, template).select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op11_neighbour_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_graph.near_vectors(read_table(spark, sf_dir, "embeddings"))


def _with_planted_tails(documents: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by its hash goes on periodically from some word on."""
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    hashed = documents.select(
        "doc_id", F.col("text").cast("string"), F.crc32(F.col("doc_id").cast("string")).alias("h")
    )
    cut = hashed.select("doc_id", "text", "h", F.when(F.col("h") % 10 == 0, words).alias("words"))
    sized = cut.select("*", F.size("words").alias("n"), F.floor(F.col("h") / 10).alias("g"))
    begun = sized.withColumn("a", F.expr("CASE WHEN n > 0 THEN int(g % n) END"))
    paced = begun.withColumn("p", F.expr("int(1 + floor((n - a) / (3 + g % 8)))"))
    tail = "slice(flatten(array_repeat(slice(words, a + 1, p), int(ceil((n - a) / p)))), 1, n - a)"
    planted = F.expr(f"concat_ws(' ', concat(slice(words, 1, a), {tail}))")
    return paced.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _with_planted_tails(read_table(spark, sf_dir, "documents"))
    found = periodic_runs.periodic_runs(documents)
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS a, -r.period AS b)))")
    listed = F.expr(r"transform(runs, r -> concat(concat_ws(',', r.start, r.length, r.period), '\n'))")
    best = found.withColumn("best", longest)
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.a")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.b")).alias("period"),
        F.expr("1000 * best.length div -best.b").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    turns = staged(prefix_trie.numbered_turns(read_table(spark, sf_dir, "conversations")), "turns")
    head = F.crc32(conv.cast("string")) % 9
    return prefix_trie.prefix_trie(prefix_trie.grafted(turns, conv - conv % 5, head, 8))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe_tree": op1_bpe_tree,
        "op2_line_runs": op2_line_runs,
        "op3_warc_segments": op3_warc_segments,
        "op4_topk_search": op4_topk_search,
        "op5_near_duplicates": op5_near_duplicates,
        "op6_toxicity": op6_toxicity,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_token_counts": op9_token_counts,
        "op10_chat_format": op10_chat_format,
        "op11_neighbour_graph": op11_neighbour_graph,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_prefix_trie": op13_prefix_trie,
    }


def _op2_sql(levels: int = 12) -> str:
    """Runs of two lines and long single ones removed; the longest repeats by windows of doubling length."""
    doubled = "".join(
        f""", s{2 * n} AS (
    SELECT doc_id, pos, dense_rank() OVER (ORDER BY r, onward) AS r FROM (
        SELECT *, lead(r, {n}) OVER (PARTITION BY doc_id ORDER BY pos) AS onward FROM s{n}
    ) WHERE onward IS NOT NULL
)"""
        for n in (2**k for k in range(levels))
    )
    shared = " UNION ALL ".join(
        f"SELECT doc_id, {n} AS length, count(*) OVER (PARTITION BY r) AS copies, true AS counts FROM s{n}"
        for n in (2**k for k in range(1, levels + 1))
    )
    shared += " UNION ALL SELECT doc_id, 1, count(*) OVER (PARTITION BY r), long FROM s1"
    return f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents WHERE coalesce(text, '') <> ''
), s1 AS (
    SELECT doc_id, pos, length(line) >= {LONG_LINE} AS long, dense_rank() OVER (ORDER BY line) AS r FROM lines
){doubled}
, longest AS (
    SELECT doc_id, max(length) AS longest_repeat FROM ({shared}) WHERE copies > 1 AND counts GROUP BY doc_id
), later AS (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY r ORDER BY doc_id, pos) AS nth FROM s2
), later_lines AS (
    SELECT doc_id, pos, long, row_number() OVER (PARTITION BY r ORDER BY doc_id, pos) AS nth FROM s1
), gone AS (
    SELECT doc_id, pos + d AS pos FROM later, (VALUES (0), (1)) AS steps(d) WHERE nth > 1
    UNION SELECT doc_id, pos FROM later_lines WHERE long AND nth > 1
), left_over AS (
    SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
           string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS kept
    FROM lines l LEFT JOIN gone g USING (doc_id, pos) GROUP BY l.doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       coalesce(longest_repeat, 0)::BIGINT AS longest_repeat,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN left_over USING (doc_id) LEFT JOIN longest USING (doc_id)
"""


OP8_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


_DIGITS = " || ".join(
    f"substr('{warc.BASE32}', (('0x' || substr(hex, {i + 1}, 5))::BIGINT >> {shift} & 31)::INT + 1, 1)"
    for i in range(0, 40, 5)
    for shift in (15, 10, 5, 0)
)
OP3_SQL = f"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
           sha1(coalesce(html, '')) AS hex, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS owner
    FROM pages
)
SELECT page_id, payload_bytes, {_DIGITS} AS payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM payloads
"""

OP4_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP10_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), rows AS (
    SELECT *, length('### ' || role || ': ' || '</turn>' || chr(10))
              + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')) AS formatted
    FROM turns
), whole AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS said,
           coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS loss,
           sum(formatted)::BIGINT AS formatted_chars
    FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM whole
"""


def _crc32_sql(number: str) -> str:
    """The unsigned CRC-32 of a whole number's decimal text, bit by bit."""
    step = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    octet = f"list_reduce(list_prepend(xor(c, b), range(8)), lambda a, i: {step})"
    codes = f"list_transform(string_split(({number})::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {octet}), 4294967295)"


OP11_SQL = """
WITH RECURSIVE whole AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM whole a JOIN whole b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
    SELECT vec_id AS u, vec_id AS v FROM whole
    UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), least AS (SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u
), counted AS (SELECT u AS vec_id, count(*) AS n_links FROM links GROUP BY u
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN counted USING (vec_id) LEFT JOIN least USING (vec_id)
"""

OP12_SQL = rf"""
WITH hashed AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{periodic_runs.WORD}') AS given,
           {_crc32_sql("doc_id")} AS h
    FROM documents
), planted AS (
    SELECT doc_id, given, len(given) AS n, h % 10 = 0 AND len(given) > 0 AS planted,
           CASE WHEN len(given) > 0 THEN (h // 10) % len(given) END AS a, 3 + (h // 10) % 8 AS parts
    FROM hashed
), paced AS (SELECT *, 1 + (n - a) // parts AS p FROM planted
), words AS (
    SELECT doc_id, n, i, given[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END] AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM paced)
), equal AS (
    SELECT x.doc_id, x.n, y.i - x.i AS d, x.i
    FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island FROM equal
), stretches AS (
    SELECT doc_id, d, min(i) AS start, count(*) + d AS length FROM islands GROUP BY doc_id, d, island
), runs AS (
    SELECT doc_id, start, length, min(d) AS period FROM stretches
    WHERE length >= greatest(6, 4 * d) GROUP BY doc_id, start, length
), per_doc AS (
    SELECT doc_id, count(*) AS n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
    FROM runs GROUP BY doc_id
), best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
), gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
       1000 * length // period AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents LEFT JOIN per_doc USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN collapsed USING (doc_id)
"""

OP13_SQL = f"""
WITH sealed AS (
    SELECT conv_id AS c, turn, strlen(coalesce(text, '')) AS n_bytes,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t
    FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
    SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, t) - 1 AS pos FROM sealed
), convs AS (SELECT c, c - c % 5 AS base, {_crc32_sql("c")} % 9 AS h FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
    SELECT v.c, 0 AS part, t.pos, t.t, t.n_bytes FROM convs v JOIN turns t ON t.c = v.base AND t.pos < v.h
    UNION ALL
    SELECT v.c, 1, t.pos, t.t, t.n_bytes FROM convs v JOIN turns t ON t.c = v.c AND t.pos >= v.h
), paths AS (
    SELECT c, list(t) OVER upto AS path, n_bytes FROM rebuilt
    WINDOW upto AS (PARTITION BY c ORDER BY part, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    UNION ALL SELECT c, [], 0 FROM convs
), lengths AS (SELECT c, max(len(path)) AS whole FROM paths GROUP BY c
), nodes AS (
    SELECT path, len(path) AS depth, min(c) AS conv_id, count(*) AS n_convs, max(n_bytes) AS n_bytes,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE whole = len(path)), '')) AS ends_sha256
    FROM paths JOIN lengths USING (c) GROUP BY path
), parents AS (
    SELECT path[:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), counted AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN parents USING (path)
), above AS (
    SELECT path[:k] AS path, n_children, (n_convs - 1) * n_bytes AS saved
    FROM (SELECT *, unnest(range(depth + 1)) AS k FROM counted)
), sums AS (
    SELECT path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM above GROUP BY path
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
       s.saved_tokens, n.ends_sha256
FROM counted n JOIN sums s USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[:n.depth - 1]
"""


def all_oracles() -> dict[str, str]:
    return {
        "op2_line_runs": _op2_sql(),
        "op3_warc_segments": OP3_SQL,
        "op4_topk_search": OP4_SQL,
        "op8_exact_dedup": OP8_SQL,
        "op10_chat_format": OP10_SQL,
        "op11_neighbour_graph": OP11_SQL,
        "op12_periodic_runs": OP12_SQL,
        "op13_prefix_trie": OP13_SQL,
    }
