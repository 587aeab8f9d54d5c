"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.staging import set_local_folder, written
from . import alignment, chat, decontaminate, fingerprints, html_text, line_dedup, merkle, mixing, ngram_join, packing, quality, token_counts, token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build):
    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(set_local_folder(spark), folder)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op2_packing(spark, folder):
    return packing.pack_documents(table(spark, folder, "documents"))


@query
def op5_token_files(spark, folder):
    path = token_files.new_token_files(table(spark, folder, "documents"))
    return token_files.read_token_files(spark, path)


@query
def op6_html_text(spark, folder):
    return html_text.extract(table(spark, folder, "pages"))


@query
def op8_token_counts(spark, folder):
    return token_counts.count_tokens(table(spark, folder, "documents"))


@query
def op9_chat(spark, folder):
    """All conversations, and one whose texts are control strings of a common format."""
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(tricky)
    path = written(chat.format_conversations(chat.linear_replies(rows)), "conversations")
    back = chat.read_back(spark.read.parquet(path))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        F.col("conversation").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE["op9_chat"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(\|[A-Za-z_]+\|>|/?s>|<SYS>>|</SYS>>|/?INST\])', '\1\2\\\3', 'g') AS safe
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(32 + length(role) + length(safe)) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query
def op10_quality(spark, folder):
    """Scores of all documents; accepted are the good ones that are not toxic."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = quality.score(docs, quality.train(docs, labels, ("quality", "toxic")))
    return scored.select(
        "doc_id", "quality_score", "toxic_score", ((F.col("quality_score") >= 0.5) & (F.col("toxic_score") < 0.5)).alias("accepted")
    )


@query
def op7_line_dedup(spark, folder):
    done = line_dedup.dedup_lines(table(spark, folder, "documents"), counts=True)
    left = F.coalesce("text", F.lit(""))
    return done.select("doc_id", "n_lines", "n_deleted", F.char_length(left).cast("long").alias("chars_left"), F.md5(left.cast("binary")).alias("text_md5"))


ORACLE["op7_line_dedup"] = """
WITH docs AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM docs
), pair AS (  -- equal lines, the later one of this document
  SELECT b.doc_id, b.i, a.doc_id AS first_doc, a.i AS first_i, len(string_split(b.line, ' ')) AS words
  FROM line a JOIN line b ON a.line = b.line AND (a.doc_id, a.i) < (b.doc_id, b.i)
), run AS (  -- pairs that follow one another are one maximal run
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, first_doc, i - first_i ORDER BY i) AS run FROM pair
), long AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id, first_doc, i - first_i, run) AS total FROM run
), gone AS (
  SELECT DISTINCT doc_id, i FROM long WHERE total >= 50
), rest AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_deleted,
         coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS left_over
  FROM line l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id
)
SELECT doc_id, n_lines, n_deleted, length(left_over) AS chars_left, md5(left_over) AS text_md5 FROM rest
"""


@query
def op4_decontamination(spark, folder):
    found = decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(F.col("_doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("equal").cast("long").alias("equal_words"))


ORACLE["op4_decontamination"] = r"""
WITH words AS (
  SELECT 0 AS kind, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents
  UNION ALL
  SELECT 1, item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') FROM benchmark
), word AS (
  SELECT kind, id, len(w) AS n, unnest(range(len(w))) AS p, unnest(w) AS w FROM words
), equal AS (  -- equal words on one diagonal
  SELECT d.id AS doc_id, i.id AS item_id, d.p - i.p AS shift, i.p AS p, i.n AS n
  FROM word d JOIN word i ON d.kind = 0 AND i.kind = 1 AND d.w = i.w AND i.n >= 4
), line AS (  -- items of one to three words are lines of their own
  SELECT id, list_filter(regexp_split_to_array(lower(line), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM (SELECT doc_id AS id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
), counted AS (
  SELECT doc_id, item_id, n,
         count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY p RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS equal_words
  FROM equal
)
SELECT doc_id, item_id, max(equal_words) AS equal_words FROM (
  SELECT doc_id, item_id, equal_words FROM counted
  WHERE equal_words >= CASE WHEN n < 7 THEN n WHEN n < 13 THEN n - 1 ELSE 11 END
  UNION ALL
  SELECT line.id, i.id, len(i.w) FROM line JOIN words i ON i.kind = 1 AND len(i.w) BETWEEN 1 AND 3 AND line.w = i.w
) GROUP BY doc_id, item_id
"""


@query
def op3_fingerprints(spark, folder):
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))


@query
def op1_ngram_join(spark, folder):
    return ngram_join.similar_documents(table(spark, folder, "documents"))


ORACLE["op1_ngram_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\t-\r ]+'), lambda w: w <> '') AS w FROM documents
), shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i+4]) END) AS s FROM words
), size AS (
  SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id
), pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
)
SELECT d.doc_id, (SELECT min(b) FROM reach WHERE reach.a = d.doc_id) AS class_id,
       (SELECT count(*) FROM link WHERE link.a = d.doc_id) AS n_links
FROM documents d
"""


@query
def op11_merkle(spark, folder):
    """The proofs of all documents, and what they say of copies some of which have lost
    their line feeds."""
    docs = table(spark, folder, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = [F.translate("text", "\n", "") if c == "text" else F.col(c) for c in columns]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    manifest = merkle.build(docs, columns, other=F.when(hit, merkle.leaf_digest(changed)))
    root = F.lit(manifest.root())
    proofs = manifest.proofs().withColumn("folded_root", merkle.folded(F.coalesce("other", "leaf"), F.col("path")))
    return proofs.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        root.cast("string").alias("root"),
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


@query
def op13_mixing(spark, folder):
    return mixing.plan_mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


_FIELDS = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"]


def _leaf_sql(text: str) -> str:
    parts = [f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in [*_FIELDS, text]]
    return f"sha256({' || '.join(parts)})"


# Trees by level: the sources' trees, then the one of their subroots; h is a node.
ORACLE["op11_merkle"] = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf, {_leaf_sql("replace(text, chr(10), '')")} AS changed,
    list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) AS crc  -- not yet inverted
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM leaf
), node AS (
  SELECT source, 0 AS level, i, n, leaf AS h FROM placed
  UNION ALL
  SELECT source, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY source, level, i // 3, n
), subroot AS (
  SELECT source, h, level AS depth, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS k, count(*) OVER () AS n FROM node WHERE n = 1
), top AS (
  SELECT 0 AS level, k AS i, n, h FROM subroot
  UNION ALL
  SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 3, n
), root AS (
  SELECT h AS root FROM top WHERE n = 1
), step AS (  -- of each leaf and level: where its node is
  SELECT p.doc_id, p.source, p.i AS leaf_i, s.level, CAST(p.i // CAST(3 ** s.level AS BIGINT) AS BIGINT) AS i FROM placed p JOIN subroot r ON r.source IS NOT DISTINCT FROM p.source JOIN (SELECT unnest(range(40)) AS level) s ON s.level < r.depth
), sides AS (
  SELECT t.source, t.leaf_i, t.level,
    coalesce(string_agg(o.h, '' ORDER BY o.i) FILTER (o.i < t.i), '') AS l, coalesce(string_agg(o.h, '' ORDER BY o.i) FILTER (o.i > t.i), '') AS r
  FROM step t JOIN node o ON o.source IS NOT DISTINCT FROM t.source AND o.level = t.level AND o.i // 3 = t.i // 3 GROUP BY ALL
), top_sides AS (
  SELECT s.source, o.level, coalesce(string_agg(o.h, '' ORDER BY o.i) FILTER (o.i < CAST(s.k // CAST(3 ** o.level AS BIGINT) AS BIGINT)), '') AS l,
    coalesce(string_agg(o.h, '' ORDER BY o.i) FILTER (o.i > CAST(s.k // CAST(3 ** o.level AS BIGINT) AS BIGINT)), '') AS r
  FROM subroot s JOIN top o ON o.n > 1 AND o.i // 3 = CAST(s.k // CAST(3 ** o.level AS BIGINT) AS BIGINT) // 3 GROUP BY ALL
), way AS (
  SELECT source, leaf_i, list(l ORDER BY level) AS ls, list(r ORDER BY level) AS rs FROM sides GROUP BY ALL
), top_way AS (
  SELECT source, list(l ORDER BY level) AS ls, list(r ORDER BY level) AS rs FROM top_sides GROUP BY ALL
), whole AS (
  SELECT p.doc_id, p.leaf, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN coalesce(changed, leaf) ELSE leaf END AS start, s.h AS subroot, root.root,
    list_concat(coalesce(w.ls, []), coalesce(t.ls, [])) AS ls, list_concat(coalesce(w.rs, []), coalesce(t.rs, [])) AS rs
  FROM placed p JOIN subroot s ON s.source IS NOT DISTINCT FROM p.source CROSS JOIN root
  LEFT JOIN way w ON w.source IS NOT DISTINCT FROM p.source AND w.leaf_i = p.i LEFT JOIN top_way t ON t.source IS NOT DISTINCT FROM p.source
), done AS (
  SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(range(1, len(ls) + 1), lambda j: ls[j] || rs[j]), '')) AS proof_sha256,
    list_reduce(list_prepend([start, ''], list_transform(range(1, len(ls) + 1), lambda j: [ls[j], rs[j]])), lambda x, y: [sha256(y[1] || x[1] || y[2]), ''])[1] AS folded_root
  FROM whole
)
SELECT *, folded_root = root AS verified FROM done
"""


# Sources by rising room for their weight; those before the first that the level does not fill are full.
ORACLE["op13_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))) AS draw
  FROM documents
), summed AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), sources AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM summed
), levels AS (
  SELECT *, 2 * source_size / weight AS room, 1.5 * sum(source_size) OVER () AS whole,
    coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
    sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM sources
), level AS (
  SELECT max(CAST(whole - held AS DOUBLE) / weights) AS level FROM levels WHERE CAST(whole - held AS DOUBLE) / weights <= room
), target AS (
  SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), weight * level) AS target FROM sources CROSS JOIN level
), before AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized
), cut AS (
  SELECT doc_id, b.source, size, source_size, target, before, CAST(floor(target) AS BIGINT) AS budget,
    CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target) AS BIGINT) // source_size END AS epochs
  FROM before b JOIN target t ON t.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, source, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM cut
"""


@query
def op12_alignment(spark, folder):
    return alignment.align(table(spark, folder, "documents"))[0]
