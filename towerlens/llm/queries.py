"""Production queries of the operators, one per operator, and the SQL that states the same result where SQL can.

Each callable takes (spark, sf_dir), applies its operator to the whole
intended table and returns the whole result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm.brown import brown_scores, seventh_held_out
from towerlens.llm.centroids import cluster_vectors, hash_order, with_totals
from towerlens.llm.common import add_total, read
from towerlens.llm.dac import read_token_files, write_token_files
from towerlens.llm.exact_dedup import exact_groups
from towerlens.llm.long_repeats import remove_long_repeats
from towerlens.llm.packing import pack
from towerlens.llm.pii import base_count, find_personal_data, joined_spans
from towerlens.llm.quality import quality_scores, quarter_held_out
from towerlens.llm.secret_scan import base_only, counted, find_secrets, joined
from towerlens.llm.simhash import near_duplicates
from towerlens.llm.toxicity import toxicity_scores
from towerlens.llm.vector_codes import encode_vectors
from towerlens.llm.winnowing import contamination

#: Normalisation of the exact operators: A-Z only, null as empty.
SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op8_cuckoo_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read(spark, sf_dir, "documents"))


OP8_SQL = f"""
WITH d AS (SELECT doc_id, sha256({SQL_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

def op1_boosted_tree_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_brown_class_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_scores(read(spark, sf_dir, "documents"), seventh_held_out())


def op3_checked_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *[base_count(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
                        F.sha2(joined_spans(base_only=True), 256).alias("base_sha256"), joined_spans(base_only=False).alias("spans"))


def op4_run_length_index_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_long_repeats(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_latent_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), quarter_held_out())
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op6_directly_addressable_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_files(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    judged, found = contamination(docs, read(spark, sf_dir, "benchmark"))
    hit = F.size(f"{found}.hit_words").cast("long")
    return judged.select("doc_id", F.col(f"{found}.n_words").alias("n_words"), hit.alias("n_hit"),
                         F.size(f"{found}.items").cast("long").alias("n_items"),
                         F.sha2(F.array_join(f"{found}.items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op9_bit_sliced_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_bounded_space_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_member_resident_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_vectors(read(spark, sf_dir, "embeddings"), keep=("label",))
    books = ",".join(str(x) for position in found.codebooks for entry in position for x in entry)
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return add_total(found.rows, "label", "error", "label_error").select(
        "vec_id", code.alias("code"), "error", "label_error", F.sha2(F.lit(books), 256).alias("codebooks_sha256"))


def op12_convolutional_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *[counted(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(joined(base_only()), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def op13_dimension_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(read(spark, sf_dir, "embeddings"), hash_order("1:"))
    return with_totals(found).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _floor_div(total: str, count: str) -> str:
    return f"(({total} - ((({total}) % {count}) + {count}) % {count}) // {count})"


def _whole_components(scale: int, condition: str) -> str:
    return f"""
v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND coalesce(isfinite(list_sum(CAST(embedding AS DOUBLE[]))), TRUE){condition}),
p AS MATERIALIZED (SELECT r, vec_id, i, CAST(floor(CAST({scale} AS DOUBLE) * embedding[i + 1]) AS BIGINT) AS x
  FROM (SELECT *, unnest(range(len(embedding))) AS i FROM v))"""


def _op11_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    steps = [_whole_components(4096, ""), f"""
q AS MATERIALIZED (SELECT r, i // w AS part, i % w AS pos, x FROM p, (SELECT (max(i) + 1) // {parts} AS w FROM p)),
s AS MATERIALIZED (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v QUALIFY e < {entries}),
c0 AS MATERIALIZED (SELECT e, part, pos, x FROM q JOIN s USING (r))"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (SELECT r, part, min(far * {entries} + e) AS best FROM (SELECT q.r, q.part, c.e, sum((q.x - c.x) * (q.x - c.x)) AS far
  FROM q JOIN c{n} c USING (part, pos) GROUP BY q.r, q.part, c.e) GROUP BY r, part)""")
        if n < rounds:
            steps.append(f"""
c{n + 1} AS MATERIALIZED (SELECT c.e, c.part, c.pos, coalesce(u.x, c.x) AS x FROM c{n} c LEFT JOIN (SELECT e, part, pos, {_floor_div('t', 'm')} AS x
  FROM (SELECT a.best % {entries} AS e, q.part, q.pos, sum(q.x) AS t, count(*) AS m FROM a{n} a JOIN q USING (r, part) GROUP BY ALL)) u USING (e, part, pos))""")
    return f"""WITH {",".join(steps)},
f AS (SELECT r, string_agg(printf('%02x', CAST(best % {entries} AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, e, pos)) FROM c{rounds}) AS codebooks_sha256
FROM v JOIN f USING (r)"""


def _op13_sql(k: int = 16, rounds: int = 3) -> str:
    steps = [_whole_components(64, " AND len(embedding) = 64"), f"""
s AS MATERIALIZED (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS e FROM v QUALIFY e < {k}),
c0 AS MATERIALIZED (SELECT e, i, x FROM p JOIN s USING (r))"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (SELECT r, min(far * {k} + e) AS best FROM (SELECT p.r, c.e, sum((p.x - c.x) * (p.x - c.x)) AS far
  FROM p JOIN c{n} c USING (i) GROUP BY p.r, c.e) GROUP BY r)""")
        if n < rounds:
            steps.append(f"""
c{n + 1} AS MATERIALIZED (SELECT c.e, c.i, coalesce(u.x, c.x) AS x FROM c{n} c LEFT JOIN (SELECT e, i, {_floor_div('t', 'm')} AS x
  FROM (SELECT a.best % {k} AS e, p.i, sum(p.x) AS t, count(*) AS m FROM a{n} a JOIN p USING (r) GROUP BY ALL)) u USING (e, i))""")
    return f"""WITH {",".join(steps)},
f AS (SELECT r, CAST(best % {k} AS INTEGER) AS cluster, CAST(best // {k} AS BIGINT) AS distance FROM a{rounds}),
h AS (SELECT e, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY e)
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM v JOIN f USING (r) JOIN h ON e = cluster"""


OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS name, regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT name, n, array_to_string(w[k:k + n - 1], ' ') AS win
       FROM (SELECT name, w, least(10, len(w)) AS n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS k FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hits AS (SELECT doc_id, k, n, name FROM dw JOIN iw USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(name, ',' ORDER BY name)) AS s FROM (SELECT DISTINCT doc_id, name FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(s, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""".replace("LOWERED", SQL_LOWER)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_boosted_tree_toxicity": op1_boosted_tree_toxicity,
    "op2_brown_class_ngrams": op2_brown_class_ngrams,
    "op3_checked_personal_data": op3_checked_personal_data,
    "op4_run_length_index_repeats": op4_run_length_index_repeats,
    "op5_latent_neighbour_quality": op5_latent_neighbour_quality,
    "op6_directly_addressable_codes": op6_directly_addressable_codes,
    "op7_winnowing_decontamination": op7_winnowing_decontamination,
    "op8_cuckoo_exact_dedup": op8_cuckoo_exact_dedup,
    "op9_bit_sliced_simhash": op9_bit_sliced_simhash,
    "op10_bounded_space_packing": op10_bounded_space_packing,
    "op11_member_resident_codes": op11_member_resident_codes,
    "op12_convolutional_secrets": op12_convolutional_secrets,
    "op13_dimension_sharded_lloyd": op13_dimension_sharded_lloyd,
}
ORACLE: dict[str, str] = {
    "op7_winnowing_decontamination": OP7_SQL,
    "op8_cuckoo_exact_dedup": OP8_SQL,
    "op11_member_resident_codes": _op11_sql(),
    "op13_dimension_sharded_lloyd": _op13_sql(),
}
