"""Queries over the driver's tables, one for each operator, and their SQL.

The tables hold no sequencing data, so reads are made of whole documents: the letters of a text, cut into
reads of READ bases, each letter one base and one quality. Both engines derive the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vdjspark.functions import airr, cigar, flat
from vdjspark.functions import sequences as S
from vdjspark.operators import clones as K
from vdjspark.operators import demultiplex as D
from vdjspark.operators import error_rates as E
from vdjspark.operators import merges as M
from vdjspark.operators import similarity as J
from vdjspark.runtime import spread, table
from vdjspark.sources.sequence_files import fastq_records, numbered

READ = 45
#: Reads of an Arrow batch.
READ_ROWS = 10_000
LETTERS = "abcdefghijklmnopqrstuvwxyz"
AS_BASES = ("ACGT" * 7)[:26]
AS_QUALITY = "".join(chr(33 + 10 + i) for i in range(26))  # Phred 10 to 35

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def reads(spark: SparkSession, sf_dir: str, bases: str = AS_BASES) -> DataFrame:
    """doc_id, source, tile, ordinal, seq, qual_text, qual"""
    return reads_of(spread(table(spark, sf_dir, "documents")), bases)


def reads_of(docs: DataFrame, bases: str = AS_BASES) -> DataFrame:
    """The reads of documents, in the order of the documents."""
    ordinal = (F.col("doc_id") * 100_000 + F.col("tile")).alias("ordinal")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select("doc_id", "source").schema)
    tiles = docs.select("doc_id", "source", F.lower("text").alias("l")).mapInArrow(_tiled(bases), f"{kinds}, tile int, seq string, qual_text string")
    return tiles.select("doc_id", "source", "tile", ordinal, "seq", "qual_text").withColumn("qual", S.decode_quality(F.col("qual_text")))


def _tiled(bases: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of lower-case texts -> the reads of their letters, in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables_ = [np.frombuffer(x.encode(), np.uint8) for x in (bases, AS_QUALITY)]
        for batch in batches:
            codes, at = flat.letters(batch.column("l"))
            good = (codes >= ord("a")) & (codes <= ord("z"))
            l, at = codes[good] - ord("a"), np.append(0, np.cumsum(good))[at]  # noqa: E741
            count = -(-np.diff(at) // READ)
            doc, tile = np.repeat(np.arange(len(count)), count), flat.ranges(np.zeros(len(count), np.int64), count)
            first = np.append(at[doc] + tile * READ, at[-1])
            for i in range(0, len(doc), READ_ROWS):
                some = slice(i, i + READ_ROWS)
                edges = first[i : i + READ_ROWS + 1]
                here = l[edges[0] : edges[-1]]
                ids = [batch.column(c).take(pa.array(doc[some])) for c in ("doc_id", "source")]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(tile[some], pa.int32()), *[flat.texts(t[here], edges - edges[0]) for t in tables_]], ["doc_id", "source", "tile", "seq", "qual_text"])

    return work


READS = f"""WITH letters AS (SELECT doc_id, source, regexp_replace(lower(text), '[^a-z]', '', 'g') AS l FROM documents),
tiles AS (SELECT doc_id, source, CAST(i AS INT) AS tile, substr(l, CAST(i * {READ} + 1 AS BIGINT), {READ}) AS t FROM letters, unnest(range(0, (length(l) + {READ - 1}) // {READ})) AS u(i)),
reads AS (SELECT doc_id, source, tile, doc_id * 100000 + tile AS ordinal, translate(t, '{LETTERS}', '{AS_BASES}') AS seq, translate(t, '{LETTERS}', '{AS_QUALITY}') AS qual_text FROM tiles),
bases AS (SELECT doc_id, source, tile, ordinal, seq, CAST(p AS INT) AS pos, substr(seq, p, 1) AS base, ascii(substr(qual_text, p, 1)) - 33 AS q FROM reads, unnest(range(1, length(seq) + 1)) AS v(p)),
clones AS (SELECT seq, count(*) AS n FROM reads GROUP BY seq),
quals AS (SELECT seq, string_agg(chr(CAST(q + 33 AS INT)), '' ORDER BY pos) AS qual_text, string_agg(CAST(CAST(q AS INT) AS VARCHAR), '|' ORDER BY pos) AS scores, min(q) AS least FROM (SELECT seq, pos, max(q) AS q FROM bases GROUP BY seq, pos) GROUP BY seq)
"""


@query(READS + "SELECT doc_id, tile, reverse(translate(seq, 'ATCG', 'TAGC')) AS rc, reverse(qual_text) AS rc_qual FROM reads")
def reverse_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads(spark, sf_dir).select("doc_id", "tile", S.reverse_complement(F.col("seq")).alias("rc"), S.encode_quality(F.reverse("qual")).alias("rc_qual"))


_CODON = "(instr('TCAG', substr(seq, CAST(i * 3 + 1 AS INT), 1)) - 1) * 16 + (instr('TCAG', substr(seq, CAST(i * 3 + 2 AS INT), 1)) - 1) * 4 + instr('TCAG', substr(seq, CAST(i * 3 + 3 AS INT), 1))"
_AA = f"array_to_string(list_transform(range(0, length(seq) // 3), lambda i: substr('{S.AMINO}', CAST({_CODON} AS INT), 1)), '')"


@query(READS + f"SELECT doc_id, tile, {_AA} AS aa, contains({_AA}, '*') AS has_stop, length(seq) % 3 = 0 AS in_frame FROM reads")
def translated_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    aa = S.translate_codons(F.col("seq"))
    return reads(spark, sf_dir).select("doc_id", "tile", aa.alias("aa"), F.contains(aa, F.lit("*")).alias("has_stop"), (F.length("seq") % 3 == 0).alias("in_frame"))


@query(READS + "SELECT doc_id, tile, seq, qual_text FROM reads")
def fastq_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads written as the four lines of FASTQ records and scanned again."""
    rows = reads(spark, sf_dir)
    four = F.array(F.concat(F.lit("@"), F.col("ordinal").cast("string"), F.lit(" x")), "seq", F.lit("+"), S.encode_quality(F.col("qual")))
    text = rows.select("ordinal", F.posexplode(four).alias("k", "value")).select((F.col("ordinal") * 4 + F.col("k")).alias("line"), "value")
    return fastq_records(text).select(F.expr("ordinal div 100000").alias("doc_id"), F.expr("cast(ordinal % 100000 as int)").alias("tile"), "seq", S.encode_quality(F.col("qual")).alias("qual_text"))


@query(READS + "SELECT c.seq AS seq, c.n AS count, q.qual_text AS qual_text, row_number() OVER (ORDER BY c.n DESC, c.seq) AS sequence_id FROM clones c JOIN quals q USING (seq)")
def clones_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads grouped by sequence, with largest qualities, numbered by abundance."""
    return K.ranked(K.build(reads(spark, sf_dir).drop("qual"))).select("seq", "count", S.encode_quality(F.col("qual")).alias("qual_text"), "sequence_id")


def _pairs_sql(d: int) -> str:
    blocks = []
    step = f"(length(seq) // {d + 1})"
    for k in range(d + 1):
        size = step if k < d else "length(seq)"
        blocks.append(f"SELECT seq AS s, length(seq) AS len, {k} AS no, substr(seq, CAST({step} * {k} + 1 AS INT), CAST({size} AS INT)) AS block FROM clones")
    return f"""blocks AS ({' UNION ALL '.join(blocks)}),
pairs AS (SELECT DISTINCT x.s AS a, y.s AS b, CAST(hamming(x.s, y.s) AS INT) AS distance FROM blocks x JOIN blocks y USING (len, no, block) WHERE x.s < y.s AND hamming(x.s, y.s) <= {d}),
both_ways AS (SELECT a AS s, b AS other, distance FROM pairs UNION ALL SELECT b, a, distance FROM pairs)
"""


@query(READS + ", " + _pairs_sql(2) + "SELECT a, b, distance FROM pairs")
def hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.hamming_pairs(reads(spark, sf_dir), 2)


@query(READS + ", " + _pairs_sql(3) + "SELECT s, other, distance FROM (SELECT *, rank() OVER (PARTITION BY s ORDER BY distance) AS r FROM both_ways) WHERE r = 1")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.nearest_neighbours(reads(spark, sf_dir), 3)


@query("WITH n AS (SELECT DISTINCT p_name AS s FROM part) SELECT x.s AS long, y.s AS short, CAST(levenshtein(x.s, y.s) AS INT) AS distance FROM n x JOIN n y ON length(x.s) = length(y.s) + 1 WHERE levenshtein(x.s, y.s) <= 2")
def levenshtein_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.levenshtein_pairs(table(spark, sf_dir, "part"), 1, 2, "p_name")


@query(READS + "SELECT CAST(length(seq) AS INT) AS seqlen, CAST(q AS INT) AS q, count(*) AS cnt FROM bases WHERE pos BETWEEN 6 AND 40 GROUP BY 1, 2")
def quality_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.quality_histogram(reads(spark, sf_dir), F.lit(5), F.lit(40))


@query(READS + "SELECT CAST(quantile_disc(q, 0.5) AS INT) AS median FROM bases WHERE pos BETWEEN 6 AND 40")
def lower_median_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.lower_median(E.quality_histogram(reads(spark, sf_dir), F.lit(5), F.lit(40)))


@query(READS + ", b AS (SELECT q, count(*) AS n, sum(CASE WHEN base = 'T' THEN 1 ELSE 0 END) AS mm FROM bases GROUP BY q), o AS (SELECT *, -10 * log10(mm / n) AS seen FROM b WHERE mm > 0) SELECT round(coalesce(sum(q / seen * n) / sum(n), 1.0), 9) AS alpha FROM o WHERE seen > 0")
def quality_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slope between stated and observed quality, with T in the part of a wrong base."""
    bases = reads(spark, sf_dir).select(F.explode(F.arrays_zip(F.filter(F.split("seq", ""), lambda c: c != "").alias("base"), F.col("qual").alias("q"))).alias("x"))
    by_quality = bases.groupBy(F.col("x.q").alias("q")).agg(F.count("*").alias("n"), F.count_if(F.col("x.base") == "T").alias("mm"))
    return E.quality_slope(by_quality).select(F.round("alpha", 9).alias("alpha"))


@query("""WITH s AS (SELECT l_returnflag AS region, sum(l_quantity) AS n, sum(l_linenumber) AS mm, sum(l_suppkey % 3) AS ins, sum(l_partkey % 2) AS dels FROM lineitem GROUP BY 1)
SELECT round(max(mm / n), 12) AS mmr, round(max(ins / n), 12) AS insr, round(max(dels / n), 12) AS delsr FROM s""")
def largest_region_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("region"), F.col("l_linestatus").alias("seqlen"), F.col("l_quantity").alias("n"), F.col("l_linenumber").alias("mm"), (F.col("l_suppkey") % 3).alias("ins"), (F.col("l_partkey") % 2).alias("dels"))
    return E.largest_rates(E.rates(E.by_region(rows))).select(*[F.round(c, 12).alias(c) for c in ("mmr", "insr", "delsr")])


@query(READS + """, f AS (SELECT source, pos, base, count(*) AS freq, max(q) AS q FROM bases GROUP BY ALL),
r AS (SELECT *, rank() OVER w AS r, sum(freq) OVER (PARTITION BY source, pos) AS total FROM f WINDOW w AS (PARTITION BY source, pos ORDER BY freq DESC, q DESC)),
c AS (SELECT source, pos, CASE WHEN count(*) = 1 THEN max(base) ELSE 'N' END AS base, CASE WHEN count(*) = 1 THEN max(q) ELSE 0 END AS q, max(total - freq) AS mutations, max(total) AS n FROM r WHERE r = 1 GROUP BY source, pos)
SELECT source, string_agg(base, '' ORDER BY pos) AS seq, string_agg(chr(CAST(q + 33 AS INT)), '' ORDER BY pos) AS qual_text, CAST(sum(n) AS BIGINT) AS base_count, CAST(sum(mutations) AS BIGINT) AS mutation_count FROM c GROUP BY source""")
def consensus_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.consensus(reads(spark, sf_dir), ["source"]).select("source", "seq", S.encode_quality(F.col("qual")).alias("qual_text"), "base_count", "mutation_count")


@query("""WITH r AS (SELECT user_id, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
p AS (SELECT a.user_id, CASE WHEN b.value > a.value THEN b.event_id ELSE a.event_id END AS event_id, CASE WHEN b.value > a.value THEN b.event_type ELSE a.event_type END AS event_type FROM r a LEFT JOIN r b ON a.user_id = b.user_id AND b.k = 2 WHERE a.k = 1) SELECT * FROM p""")
def first_two_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return K.best_of_first_two(rows, ["user_id"], F.col("value"), "event_id").select("user_id", "event_id", "event_type")


@query(READS + """, k AS (SELECT doc_id, seq, count(*) AS n, min(ordinal) AS ordinal, sum(list_sum(list_transform(range(1, length(seq) + 1), lambda i: ascii(substr(qual_text, CAST(i AS INT), 1)) - 33))) AS s FROM reads GROUP BY 1, 2)
SELECT doc_id, seq, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, s DESC, ordinal) AS INT) AS rank, count(*) OVER (PARTITION BY doc_id) AS of FROM k""")
def subgroup_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's distinct reads ranked by count, then summed quality, then order."""
    total = F.aggregate("qual", F.lit(0), lambda s, q: s + q)
    rows = reads(spark, sf_dir).groupBy("doc_id", "seq").agg(F.count("*").alias("count"), F.min("ordinal").alias("ordinal"), F.sum(total).cast("int").alias("s")).withColumn("qual", F.array("s"))
    return K.subgroup_ranks(rows, ["doc_id"]).select("doc_id", "seq", "rank", "of")


@query("SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def dimension_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey").select("c_custkey", "o_totalprice")
    found = J.looked_up(J.looked_up(orders, table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), ["c_custkey"]), table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), ["n_nationkey"])
    return found.groupBy("n_name").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(READS + "SELECT a.doc_id, CAST(a.tile // 2 AS INT) AS pair, a.seq AS seq1, b.seq AS seq2 FROM reads a JOIN reads b ON a.doc_id = b.doc_id AND a.tile + 1 = b.tile WHERE a.tile % 2 = 0")
def mate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even and odd reads of a document joined by position."""
    rows = reads(spark, sf_dir).select("doc_id", (F.col("tile") / 2).cast("int").alias("pair"), (F.col("tile") % 2).alias("mate"), "seq")
    both = rows.groupBy("doc_id", "pair").agg(*[F.max(F.when(F.col("mate") == k, F.col("seq"))).alias(f"seq{k + 1}") for k in (0, 1)])
    return both.filter("seq2 is not null")


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS has_orders FROM customer")
def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return J.members(customers, orders, ["c_custkey"]).withColumn("has_orders", F.lit(True)).unionByName(J.members(customers, orders, ["c_custkey"], absent=True).withColumn("has_orders", F.lit(False)))


@query(READS + f"SELECT seq, NOT (q.least < 12 OR contains({_AA}, '*') OR length(seq) % 3 <> 0) AS kept FROM clones JOIN quals q USING (seq)")
def routed_clones(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = K.build(reads(spark, sf_dir).drop("qual"))
    rows = rows.withColumn("stop_codon", F.when(F.contains(S.translate_codons(F.col("seq")), F.lit("*")), "T").otherwise("F")).withColumn("vj_in_frame", F.when(F.length("seq") % 3 == 0, "T").otherwise("F"))
    kept, discarded = K.routed(rows, 12)
    return kept.select("seq", F.lit(True).alias("kept")).unionByName(discarded.select("seq", F.lit(False).alias("kept")))


@query("""WITH c AS (SELECT l_orderkey, l_linenumber AS s, CAST(l_quantity AS INT) AS m, CAST(l_suppkey % 4 + 1 AS INT) AS d, CAST(l_partkey % 5 + 1 AS INT) AS i, CAST(l_suppkey % 50 AS INT) AS ras FROM lineitem)
SELECT l_orderkey, s AS line, s AS qas, s + m + i + 7 AS qae, ras + m + d + 7 AS rae, s + m // 2 AS at_match, CAST(NULL AS INT) AS at_gap, s + m + i AS after_gap FROM c""")
def cigar_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CIGAR strings made of order lines, measured and used to map reference positions."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("int").alias("m"), (F.col("l_suppkey") % 4 + 1).cast("int").alias("d"), (F.col("l_partkey") % 5 + 1).cast("int").alias("i"), (F.col("l_suppkey") % 50).cast("int").alias("ras"))
    rows = rows.withColumn("cigar", F.concat("line", F.lit("S"), "m", F.lit("M"), "d", F.lit("D"), "i", F.lit("I7M3S")))
    c, ras, ops = F.col("cigar"), F.col("ras"), F.col("ops")
    rows = rows.withColumn("ops", cigar.placed(c, ras))
    span = cigar.intervals(c, ras, ops)
    at = [cigar.query_position(c, ras, t, ops) for t in (ras + (F.col("m") / 2).cast("int"), ras + F.col("m"), ras + F.col("m") + F.col("d"))]
    return rows.select("l_orderkey", "line", span["qas"].alias("qas"), span["qae"].alias("qae"), span["rae"].alias("rae"), at[0].alias("at_match"), at[1].alias("at_gap"), at[2].alias("after_gap"))


# Adapters of the demultiplexing query.
ADAPTERS = [D.Adapter("S1", "yrACGTrNNNN"), D.Adapter("S2", "wCATGsNNNN"), D.Adapter("S3", "GGTTANNNNN")]


def _adapters_sql() -> str:
    rows = []
    for k, a in enumerate(ADAPTERS):
        p = D.Pattern(a.pattern)
        (low, high), (at, seed) = p.identifier[0], p.seed
        rows.append(f"SELECT {k} AS k, '{a.sample}' AS sample, {at} AS ahead, '{seed}' AS seed, {p.allowed} AS allowed, {low} AS low, {high} AS high")
    return " UNION ALL ".join(rows)


@query(
    READS
    + f""", adapters AS ({_adapters_sql()}),
strands AS (SELECT ordinal, 0 AS rc, seq AS s, qual_text AS q FROM reads UNION ALL SELECT ordinal, 1, reverse(translate(seq, 'ACGT', 'TGCA')), reverse(qual_text) FROM reads),
spots AS (SELECT ordinal, rc, s, q, k, sample, allowed, low, high, CAST(p - 1 - ahead AS INT) AS st FROM strands, adapters, unnest(range(1, length(s) + 1)) AS u(p) WHERE substr(s, CAST(p AS INT), length(seed)) = seed AND p - 1 - ahead >= 0 AND p - 1 - ahead + len(allowed) <= length(s)),
judged AS (SELECT *, CAST(list_sum(list_transform(range(1, len(allowed) + 1), lambda i: CASE WHEN contains(allowed[i], substr(s, CAST(st + i AS INT), 1)) THEN 0 ELSE 1 END)) AS INT) AS wrong FROM spots WHERE contains(allowed[-1], substr(s, CAST(st + len(allowed) AS INT), 1))),
best AS (SELECT *, substr(s, st + low + 1, high - low) AS umi, substr(q, st + low + 1, high - low) AS umi_qual FROM judged WHERE wrong <= 2 QUALIFY row_number() OVER (PARTITION BY ordinal ORDER BY wrong, k, rc, st) = 1)
SELECT sample, ordinal || CASE WHEN rc = 1 THEN ' rc' ELSE '' END || ' UMI:R1:' || umi || ':' || umi_qual AS id, umi, umi_qual, s AS seq, q AS qual_text, wrong AS mismatches FROM best"""
)
def demultiplexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.demultiplex(reads(spark, sf_dir).withColumn("id", F.col("ordinal").cast("string")), ADAPTERS)


def _hits_sql() -> str:
    rows = []
    for a in ADAPTERS:
        p = D.Pattern(a.pattern)
        at, seed = p.seed
        rows.append(f"SELECT '{a.sample}' AS sample, false AS rc, {at} AS ahead, '{seed}' AS seed, {p.allowed} AS allowed")
        rows.append(f"SELECT '{a.sample}', true, {len(p.allowed) - at - len(seed)}, '{D.turned(seed)}', {[D.turned(x) for x in reversed(p.allowed)]}")
    return " UNION ALL ".join(rows)


@query(
    READS
    + f""", adapters AS ({_hits_sql()}),
spots AS (SELECT ordinal, seq, sample, rc, allowed, CAST(p - 1 - ahead AS INT) AS start FROM reads, adapters, unnest(range(1, length(seq) + 1)) AS u(p) WHERE substr(seq, CAST(p AS INT), length(seed)) = seed AND p - 1 - ahead >= 0 AND p - 1 - ahead + len(allowed) <= length(seq)),
judged AS (SELECT ordinal, sample, rc, start, CAST(list_sum(list_transform(range(1, len(allowed) + 1), lambda i: CASE WHEN contains(allowed[i], substr(seq, CAST(start + i AS INT), 1)) THEN 0 ELSE 1 END)) AS INT) AS mismatches FROM spots WHERE contains(allowed[-1], substr(seq, CAST(start + len(allowed) AS INT), 1)))
SELECT ordinal AS id, sample, rc, CAST(row_number() OVER (PARTITION BY ordinal, sample, rc ORDER BY mismatches, start) AS INT) AS number, mismatches, start FROM judged WHERE mismatches <= 2"""
)
def adapter_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of every adapter, on both strands."""
    return D.adapter_hits(reads(spark, sf_dir).withColumn("id", F.col("ordinal")), ADAPTERS)


@query("WITH n AS (SELECT DISTINCT p_name AS s FROM part), p AS (SELECT x.s AS s, y.s AS other, CAST(hamming(x.s, y.s) AS INT) AS distance FROM n x JOIN n y ON length(x.s) = length(y.s) AND x.s <> y.s) SELECT s, other, distance FROM p QUALIFY rank() OVER (PARTITION BY s ORDER BY distance) = 1")
def nearest_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest others of every part name, however far."""
    return J.nearest_neighbours(table(spark, sf_dir, "part"), None, "p_name")


@query(
    READS
    + """, pairs AS (SELECT a.doc_id, a.tile, a.ordinal AS ia, b.ordinal AS ib, CAST(a.ordinal % 3 + 1 AS BIGINT) AS na, CAST(b.ordinal % 4 + 1 AS BIGINT) AS nb, CAST(a.ordinal % 7 AS INT) AS ra, CAST(b.ordinal % 5 AS INT) AS rb, length(a.seq) AS la, length(b.seq) AS lb FROM reads a JOIN reads b ON a.doc_id = b.doc_id AND b.tile = a.tile + 1 WHERE length(b.seq) >= 10),
cells AS (SELECT p.doc_id, p.tile, pos, base, q, na AS n, 0 AS side FROM pairs p JOIN bases x ON x.ordinal = ia UNION ALL SELECT p.doc_id, p.tile, pos + ra - rb, base, q, nb, 1 FROM pairs p JOIN bases x ON x.ordinal = ib),
f AS (SELECT doc_id, tile, pos, base, sum(n) AS freq, max(q) AS q FROM cells GROUP BY ALL),
r AS (SELECT *, rank() OVER w AS r, sum(freq) OVER (PARTITION BY doc_id, tile, pos) AS total FROM f WINDOW w AS (PARTITION BY doc_id, tile, pos ORDER BY freq DESC, q DESC)),
c AS (SELECT doc_id, tile, pos, CASE WHEN count(*) = 1 THEN max(base) ELSE 'N' END AS base, CASE WHEN count(*) = 1 THEN max(q) ELSE 0 END AS q, max(total - freq) AS wrong FROM r WHERE r = 1 GROUP BY ALL),
s AS (SELECT doc_id, tile, string_agg(base, '' ORDER BY pos) AS seq, string_agg(chr(CAST(q + 33 AS INT)), '' ORDER BY pos) AS qual_text, CAST(sum(wrong) AS BIGINT) AS mutations FROM c GROUP BY ALL),
d AS (SELECT x.doc_id, x.tile, least(x.q, y.q) AS q FROM cells x JOIN cells y USING (doc_id, tile, pos) WHERE x.side = 0 AND y.side = 1 AND x.base <> y.base),
m AS (SELECT doc_id, tile, CAST(count(*) AS INT) AS hd, CAST(sum(q) AS INT) AS sum_q, CAST(max(q) AS INT) AS max_q FROM d GROUP BY ALL)
SELECT doc_id, tile, seq, qual_text, mutations, na + nb AS count, greatest(na, nb) AS orig_count, greatest(ra, rb) AS refpos, coalesce(hd, 0) AS hd, coalesce(sum_q, 0) AS sum_q, coalesce(max_q, 0) AS max_q FROM pairs JOIN s USING (doc_id, tile) LEFT JOIN m USING (doc_id, tile)"""
)
def offset_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring reads as clones with anchors, added where the anchors meet, and how they differ there."""
    both = K.with_next(reads(spark, sf_dir).select("doc_id", "tile", "ordinal", "seq", "qual_text"), "doc_id", "tile").filter(F.length("b.seq") >= 10)

    def clone(side: str, copies: int, anchors: int) -> Column:
        o = F.col(f"{side}.ordinal")
        n = o % copies + 1
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in ("seq", "qual_text")], n.alias("count"), n.alias("orig_count"), (o % anchors).cast("int").alias("refpos"))

    out = both.select("a.doc_id", "a.tile", K.summed(clone("a", 3, 7), clone("b", 4, 5)).alias("s"))
    return out.select("doc_id", "tile", *[f"s.{c}" for c in ("seq", "qual_text", "mutations", "count", "orig_count", "refpos", "hd", "sum_q", "max_q")])


@query()
def umi_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consensus of reads that share source and their first five bases."""
    rows = reads(spark, sf_dir).select(F.col("source").alias("qualifier"), F.substring("seq", 1, 5).alias("umi"), "ordinal", "seq", "qual")
    return D.umi_names(K.subgroup_ranks(D.umi_consensus(rows), ["qualifier", "umi"])).select("id", "seq", "qual_text", "count")


def _clones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.start(K.build(reads(spark, sf_dir).drop("qual")))


def _shown(clones: DataFrame) -> DataFrame:
    return clones.select("seq", S.encode_quality(F.col("qual")).alias("qual_text"), "count", "orig_count", "mutations")


@query()
def merged_by_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(M.merge_by_quality(_clones(spark, sf_dir), 0.01))


@query()
def merged_by_abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(M.merge_by_abundance(_clones(spark, sf_dir), 0.01))


@query()
def merged_indels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(M.merge_indels(_clones(spark, sf_dir), 0.001, 0.001))


@query()
def merged_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The letter b is an unknown base."""
    rows = reads(spark, sf_dir, AS_BASES[0] + "N" + AS_BASES[2:])
    # equal reads have N at equal places
    clones = K.build(rows.drop("qual"))
    return _shown(M.merge_unknown(M.start(clones.withColumn("qual", S.zero_unknown(F.col("seq"), F.col("qual"))))))


_AA_OF_FULL = _AA.replace("(seq", "(f")


@query(
    READS
    + f""", n AS (SELECT count(*) // 2 AS n FROM benchmark), items AS (SELECT row_number() OVER (ORDER BY item_id) - 1 AS k, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{LETTERS}', '{AS_BASES}') AS ref FROM benchmark),
ids AS (SELECT c.seq, c.n, q.scores, q.least, row_number() OVER (ORDER BY c.n DESC, c.seq) AS id FROM clones c JOIN quals q USING (seq)),
full_ AS (SELECT ids.*, 'TRBV' || id % n.n || '*01' AS v_call, 'TRBJ' || id % n.n || '*01' AS j_call, v.ref AS v, j.ref AS j, substr(v.ref, 1, 27) || seq || substr(j.ref, 34) AS f FROM ids, n JOIN items v ON v.k = 2 * (id % n.n) JOIN items j ON j.k = 2 * (id % n.n) + 1),
aa AS (SELECT *, {_AA} AS jaa, {_AA_OF_FULL} AS faa FROM full_),
res AS (SELECT *, {_AA.replace("(seq", "(substr(v, 28, 3)")} AS av, {_AA.replace("(seq", "(substr(j, 31, 3)")} AS aj FROM aa)
SELECT CAST(id AS VARCHAR) AS sequence_id, f AS sequence, 'F' AS rev_comp, CASE WHEN jaa <> '' AND substr(jaa, 1, 1) = av AND jaa[-1] = aj AND NOT contains(faa, '*') THEN 'T' ELSE 'F' END AS productive, v_call, '' AS d_call, j_call, '' AS sequence_alignment, '' AS germline_alignment,
  seq AS junction, jaa AS junction_aa, '' AS v_cigar, '' AS d_cigar, '' AS j_cigar, CAST(n AS VARCHAR) AS duplicate_count, CASE WHEN length(f) % 3 = (length(j) - 30) % 3 THEN 'T' ELSE 'F' END AS vj_in_frame, CASE WHEN contains(faa, '*') THEN 'T' ELSE 'F' END AS stop_codon,
  '31' AS cdr3_start, CAST(31 + length(seq) - 7 AS VARCHAR) AS cdr3_end, '37' AS v_sequence_end, '58' AS j_sequence_start, scores AS junction_quality_scores, CAST(least AS VARCHAR) AS junction_minimum_quality_score, '10' AS v_junction_end, '31' AS j_junction_start FROM res"""
)
def rearrangement_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clones with alleles made of the benchmark's texts."""
    items = numbered(table(spark, sf_dir, "benchmark").orderBy("item_id"), "k")
    seq = F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), LETTERS, AS_BASES)
    alleles = items.select(F.concat(F.when(F.col("k") % 2 == 0, "TRBV").otherwise("TRBJ"), (F.col("k") / 2).cast("int").cast("string"), F.lit("*01")).alias("name"), F.lit(30).alias("refpos"), seq.alias("seq"))
    n = items.count() // 2
    clones = K.ranked(K.build(reads(spark, sf_dir).drop("qual")))
    pick = F.pmod("sequence_id", F.lit(max(1, n))).cast("string")
    clones = clones.withColumn("v_call", F.concat(F.lit("TRBV"), pick, F.lit("*01"))).withColumn("j_call", F.concat(F.lit("TRBJ"), pick, F.lit("*01"))).withColumn("v_end", F.lit(10)).withColumn("j_start", F.lit(30))
    return airr.rearrangements(clones, alleles)
