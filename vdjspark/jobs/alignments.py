"""More queries: alignments derived from the reads, names and numbers derived from order lines, and files both ways.

Each read of full length is given a V and a J alignment whose places, flags and operations follow from
its number, and alleles come from the nations and regions; the SQL computes the same without CIGAR strings.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vdjspark.functions import sequences as S
from vdjspark.jobs import repertoire
from vdjspark.jobs.registry import _AA, AS_BASES, LETTERS, READ, READS, _pairs_sql, query, reads, reads_of
from vdjspark.operators import aligners
from vdjspark.operators import clones as K
from vdjspark.operators import demultiplex as D
from vdjspark.operators import error_rates as E
from vdjspark.operators import merges as M
from vdjspark.operators import similarity as J
from vdjspark.runtime import shared_dir, spread, table
from vdjspark.sources import sequence_files as files
from vdjspark.sources import tables

V_REF, J_REF = "ACGT" * 25, "TGCA" * 10


def alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, refpos, seq: a V for each nation and a J for each region."""
    v = table(spark, sf_dir, "nation").select(F.concat(F.lit("TRBV"), "n_nationkey", F.lit("*01")).alias("name"), (F.col("n_nationkey") + 20).alias("refpos"), F.lit(V_REF).alias("seq"))
    j = table(spark, sf_dir, "region").select(F.concat(F.lit("TRBJ"), "r_regionkey", F.lit("*01")).alias("name"), (F.col("r_regionkey") + 8).alias("refpos"), F.lit(J_REF).alias("seq"))
    return v.unionByName(j)


def sam_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """uid and structs v, j of all reads of full length. V: 5M2I(13+m)M3D4M and the rest clipped; J, of what is left: 2S10M1D(9-m)M; m is uid mod 3."""
    rows = reads(spark, sf_dir).filter(F.length("seq") == READ).withColumn("m", (F.col("ordinal") % 3).cast("int"))
    o, m, at = F.col("ordinal"), F.col("m"), F.col("m") + 25

    def sam(flag, rname, pos, mapq, cigar, seq, qual):
        values = {"QNAME": F.concat(F.lit("r"), o), "FLAG": flag, "RNAME": rname, "POS": pos, "MAPQ": mapq, "CIGAR": cigar, "RNEXT": F.lit("*"), "PNEXT": F.lit(0), "TLEN": F.lit(0), "SEQ": seq, "QUAL": qual}
        return F.struct(*[values[c].cast("int" if c in files.SAM_INTEGERS else "string").alias(c) for c in files.SAM_COLUMNS])

    v = sam(F.when(o % 13 == 0, 4).otherwise(0), F.concat(F.lit("TRBV"), F.col("doc_id") % 25, F.lit("*01")), o % 7 + 11, o % 50, F.concat(F.lit("5M2I"), m + 13, F.lit("M3D4M"), 21 - m, F.lit("S")), F.col("seq"), F.col("qual_text"))
    rest = [F.substring(c, at, F.lit(READ)) for c in ("seq", "qual_text")]
    j = sam(F.when(o % 17 == 0, 16).otherwise(0), F.concat(F.lit("TRBJ"), F.col("doc_id") % 5, F.lit("*01")), o % 4 + 1, o % 60, F.concat(F.lit("2S10M1D"), 9 - m, F.lit("M")), *rest)
    return rows.select(o.alias("uid"), v.alias("v"), j.alias("j"))


PAIRS = READS + f""", pairs AS (SELECT ordinal AS uid, CAST(ordinal % 3 AS INT) AS m, seq, qual_text, CAST(10 + ordinal % 7 AS INT) AS vr, CAST(ordinal % 4 AS INT) AS jr, CAST(doc_id % 25 AS INT) AS vk, CAST(doc_id % 5 AS INT) AS jk,
  ordinal % 13 = 0 AS v_unmapped, ordinal % 17 = 0 AS j_reversed, CAST(ordinal % 50 AS INT) AS v_score, CAST(ordinal % 60 AS INT) AS j_score FROM reads WHERE length(seq) = {READ}),
placed AS (SELECT *, 17 + vk AS vt, 11 + jk AS jt FROM pairs JOIN nation ON n_nationkey = vk JOIN region ON r_regionkey = jk WHERE NOT v_unmapped AND NOT j_reversed),
anchored AS (SELECT *, CASE WHEN vt < vr THEN NULL WHEN vt < vr + 5 THEN vt - vr WHEN vt < vr + 18 + m THEN vt - vr + 2 WHEN vt < vr + 21 + m THEN NULL WHEN vt < vr + 25 + m THEN vt - vr - 1 END AS s,
  24 + m + CASE WHEN jt < jr THEN NULL WHEN jt < jr + 10 THEN jt - jr + 2 WHEN jt < jr + 11 THEN NULL WHEN jt < jr + 20 - m THEN jt - jr + 1 END AS e FROM placed),
junctions AS (SELECT *, substr(seq, s + 1, e - s) AS jnc, substr(qual_text, s + 1, e - s) AS jnc_qual, 24 + m - s AS v_end, 26 + m - s AS j_start FROM anchored WHERE s IS NOT NULL AND e IS NOT NULL AND e <= {READ} AND e - s >= 10),
blocks AS (SELECT 'V' AS region, uid, m, length(jnc) AS seqlen, seq, qual_text, vt AS low, 100 AS high, '{V_REF}' AS ref, unnest([{{'q': 0, 'r': vr, 'n': 5}}, {{'q': 7, 'r': vr + 5, 'n': 13 + m}}, {{'q': 20 + m, 'r': vr + 21 + m, 'n': 4}}]) AS b FROM junctions
  UNION ALL SELECT 'J', uid, m, length(jnc), substr(seq, 25 + m), substr(qual_text, 25 + m), 0, jt, '{J_REF}', unnest([{{'q': 2, 'r': jr, 'n': 10}}, {{'q': 12, 'r': jr + 11, 'n': 9 - m}}]) FROM junctions),
seen AS (SELECT region, uid, seqlen, ascii(substr(qual_text, CAST(b.q + i + 1 AS INT), 1)) - 33 AS q, substr(seq, CAST(b.q + i + 1 AS INT), 1) <> substr(ref, CAST(b.r + i + 1 AS INT), 1) AS wrong FROM blocks, unnest(range(0, b.n)) AS u(i) WHERE b.r + i >= low AND b.r + i < high),
gaps AS (SELECT 'V' AS region, uid, length(jnc) AS seqlen, CASE WHEN vr + 5 >= vt THEN 2 ELSE 0 END AS ins, CASE WHEN vr + 18 + m >= vt THEN 3 ELSE 0 END AS dels, qual_text FROM junctions
  UNION ALL SELECT 'J', uid, length(jnc), 0, CASE WHEN jr + 10 < jt THEN 1 ELSE 0 END, qual_text FROM junctions),
stats AS (SELECT g.region, g.seqlen, sum(coalesce(k.n, 0) + g.ins) AS n, sum(coalesce(k.mm, 0)) AS mm, sum(g.ins) AS ins, sum(g.dels) AS dels FROM gaps g LEFT JOIN (SELECT region, uid, count(*) AS n, count_if(wrong) AS mm FROM seen GROUP BY ALL) k USING (region, uid) GROUP BY ALL),
between_q AS (SELECT length(jnc) AS seqlen, ascii(substr(jnc_qual, CAST(i AS INT), 1)) - 33 AS q FROM junctions, unnest(range(greatest(v_end, 0) + 1, j_start + 1)) AS u(i))
"""


def found_junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.junctions(sam_pairs(spark, sf_dir), alleles(spark, sf_dir), 10, ("v", "j", "v_ref", "j_ref"))


@query(PAIRS + "SELECT uid AS ordinal, jnc AS seq, jnc_qual AS qual_text, 'TRBV' || vk || '*01' AS v_call, 'TRBJ' || jk || '*01' AS j_call, CAST(v_end AS INT) AS v_end, CAST(j_start AS INT) AS j_start, v_score, j_score FROM junctions")
def junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Junctions between the anchors of V and J, where both alignments reach them."""
    return K.junctions(sam_pairs(spark, sf_dir), alleles(spark, sf_dir))


@query(PAIRS + "SELECT region, CAST(seqlen AS INT) AS seqlen, CAST(n AS BIGINT) AS n, CAST(mm AS BIGINT) AS mm, CAST(ins AS BIGINT) AS ins, CAST(dels AS BIGINT) AS dels FROM stats")
def alignment_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the alignments by region and junction length."""
    return repertoire.alignment_stats(found_junctions(spark, sf_dir))[0]


@query(
    PAIRS
    + """, every AS (SELECT region, q, wrong FROM seen UNION ALL SELECT region, ascii(substr(qual_text, CAST(i AS INT), 1)) - 33, false FROM gaps, unnest([6, 7]) AS u(i) WHERE ins > 0),
c AS (SELECT region, q, count(*) AS n, count_if(wrong) AS mm FROM every GROUP BY ALL)
SELECT r.region, CAST(x AS INT) AS "Q", coalesce(c.n, 0) AS n, coalesce(c.mm, 0) AS mm FROM (SELECT DISTINCT region FROM c) r, unnest(range(0, 42)) AS u(x) LEFT JOIN c ON c.region = r.region AND c.q = x"""
)
def alignment_qualities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned bases by region and quality, with those that differ; every quality has a row."""
    return repertoire.all_qualities(repertoire.alignment_stats(found_junctions(spark, sf_dir))[1])


@query(
    PAIRS
    + """, a AS (SELECT seqlen, sum(mm) AS mm, sum(n) AS n FROM stats GROUP BY 1), x AS (SELECT seqlen, sum(pow(10.0, -(q / 1.1) / 10)) AS e, count(*) AS m FROM between_q GROUP BY 1)
SELECT CAST(coalesce(a.seqlen, x.seqlen) AS INT) AS seqlen, round(greatest((coalesce(a.mm, 0) + coalesce(x.e, 0)) / (coalesce(a.n, 0) + coalesce(x.m, 0)), 0.6), 9) AS mmr FROM a FULL JOIN x ON a.seqlen = x.seqlen"""
)
def length_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mismatch rate of each junction length, from alignments and from the qualities between V and J; 0.6 at least."""
    sums, _, between = repertoire.statistics(found_junctions(spark, sf_dir))
    return E.rates_by_length(sums, between, 1.1, 0.6).select("seqlen", F.round("mmr", 9).alias("mmr"))


@query(PAIRS + "SELECT uid, CASE WHEN v_unmapped THEN '' ELSE substr(seq, 25 + m) END AS seq, CASE WHEN v_unmapped THEN '' ELSE substr(qual_text, 25 + m) END AS qual FROM pairs")
def v_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What V leaves of a read for J."""
    return sam_pairs(spark, sf_dir).select("uid", K.after_v(F.col("v")).alias("r")).select("uid", "r.*")


@query(PAIRS + "SELECT uid, 'r' || uid AS v_name, 'r' || uid AS j_name, substr(seq, 25 + m) AS j_seq FROM pairs WHERE uid % 5 <> 0")
def uid_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V and J rows that come apart are joined by the uid in J's name."""
    pairs = sam_pairs(spark, sf_dir)
    j = pairs.filter("uid % 5 <> 0").select("uid", "j.*").withColumn("QNAME", F.concat_ws(":", "uid", "QNAME")).drop("uid")
    return K.paired_by_uid(pairs.select("uid", "v.*"), j).select("uid", F.col("v.QNAME").alias("v_name"), F.col("j.QNAME").alias("j_name"), F.col("j.SEQ").alias("j_seq"))


@query(PAIRS + ", n AS (SELECT *, row_number() OVER (ORDER BY uid) - 1 AS n FROM pairs) SELECT a.n // 2 AS uid, a.uid AS v_read, b.uid AS j_read, CAST(a.vr + 1 AS INT) AS v_pos, b.seq AS j_seq FROM n a JOIN n b ON a.n + 1 = b.n WHERE a.n % 2 = 0")
def sam_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of SAM, with header lines between, scanned; every two rows are a V and a J."""
    rows = sam_pairs(spark, sf_dir)
    text = rows.select((F.col("uid") * 2 + 1).alias("line"), F.concat_ws("\t", *[F.col(f"v.{c}").cast("string") for c in files.SAM_COLUMNS]).alias("value"))
    heads = rows.filter("uid % 10 = 0").select((F.col("uid") * 2).alias("line"), F.concat_ws("\t", F.lit("@SQ"), F.concat(F.lit("SN:"), "uid"), F.lit("LN:9")).alias("value"))
    found = files.adjacent_pairs(files.sam_records(text.unionByName(heads)))
    number = lambda side: F.substring(f"{side}.QNAME", 2, 20).cast("long")
    return found.select("uid", number("v").alias("v_read"), number("j").alias("j_read"), F.col("v.POS").alias("v_pos"), F.col("j.SEQ").alias("j_seq"))


_N_BASES = AS_BASES[0] + "N" + AS_BASES[2:]


@query(READS + f", k AS (SELECT doc_id, tile, translate(t, '{LETTERS}', '{_N_BASES}') AS s, qual_text AS q FROM tiles JOIN reads USING (doc_id, tile)) SELECT doc_id, tile, array_to_string(list_transform(range(1, length(s) + 1), lambda i: CASE WHEN substr(s, CAST(i AS INT), 1) = 'N' THEN '!' ELSE substr(q, CAST(i AS INT), 1) END), '') AS qual_text FROM k")
def zeroed_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reads(spark, sf_dir, _N_BASES)
    return rows.select("doc_id", "tile", S.encode_quality(S.zero_unknown(F.col("seq"), F.col("qual"))).alias("qual_text"))


_LINES = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem"


@query(f"WITH l AS ({_LINES}) SELECT l_orderkey, l_partkey, l_linenumber, CAST(round(10 * log10(pow(10.0, (l_suppkey % 46 - 5) / 10.0) + 1)) AS INT) AS phred, round(-10 * log10((l_suppkey % 46 + 1) / 50.0), 9) AS as_quality FROM l")
def solexa_qualities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", (F.col("l_suppkey") % 46).alias("k"))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", S.solexa_to_phred(F.col("k") - 5).alias("phred"), F.round(S.probability_to_phred((F.col("k") + 1) / 50.0), 9).alias("as_quality"))


_Z = 2.3263478740408408


@query(
    f"""WITH l AS ({_LINES}), k AS (SELECT *, CAST(l_quantity AS INT) AS n, CAST(l_linenumber AS INT) AS h FROM l)
SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN h > n THEN 0.0 ELSE round(exp(lgamma(n + 1) - lgamma(h + 1) - lgamma(n - h + 1)) * pow(0.02, h) * pow(0.98, n - h), 9) END AS chance, round(l_extendedprice * 0.01 + {_Z} * sqrt(l_extendedprice * 0.01 * 0.99), 6) AS budget FROM k"""
)
def error_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chance of so many errors in a length, and the errors to expect in so many bases at a confidence of 0.99."""
    rows = table(spark, sf_dir, "lineitem")
    chances = F.array(*M.binomials(F.col("l_quantity"), F.lit(0.02), 7))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", F.round(F.get(chances, F.col("l_linenumber")), 9).alias("chance"), F.round(E.mutation_budget(F.col("l_extendedprice"), 0.01, 0.99), 6).alias("budget"))


@query("SELECT event_id, 'TRB' AS gene, CASE WHEN user_id % 2 = 0 THEN 'V' ELSE 'J' END AS region, user_id || '-' || event_id % 7 AS segment, '0' || event_id % 9 AS allele, 'R' || event_id % 2 + 1 AS qualifier, event_type AS umi, 'I:' || user_id || ':' AS umi_qual FROM events")
def parsed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allele names and identifiers' names in their parts."""
    region = F.when(F.col("user_id") % 2 == 0, "V").otherwise("J")
    rows = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("TRB"), region, "user_id", F.lit("-"), F.col("event_id") % 7, F.lit("*0"), F.col("event_id") % 9).alias("allele_name"), F.concat(F.lit("UMI:R"), F.col("event_id") % 2 + 1, F.lit(":"), "event_type", F.lit(":I:"), "user_id", F.lit(":")).alias("name"))
    return rows.select("event_id", S.allele_parts(F.col("allele_name")).alias("a"), S.umi_parts(F.col("name")).alias("u")).select("event_id", "a.*", "u.*")


@query(READS + f"SELECT count(*) FILTER (n >= 2) AS several, {_AA} AS aa, max(c.n || ' ' || c.seq || ' ' || {_AA} || ' ' || (length({_AA}) - length(replace({_AA}, '*', ''))) || ' ' || length(seq) % 3 || ' ' || q.least || '%') AS line FROM clones c JOIN quals q USING (seq) GROUP BY seq, n, least")
def template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clones by a user's template."""
    rows = K.build(reads(spark, sf_dir).drop("qual")).select("*", *[F.lit(None).cast(t).alias(c) for c, t in M.NOTE.items()])
    line = K.formatted("%(count)s %(nt_seq)s %(aa_seq)s %(n_stop_codons)s %(frame)s %(min_phred)s%%")
    return rows.select((F.col("count") >= 2).cast("long").alias("several"), S.translate_codons(F.col("seq")).alias("aa"), line.alias("line"))


@query(READS + "SELECT ordinal, '(' || ordinal || ',' || ordinal || ')' AS name, seq || reverse(translate(seq, 'ATCG', 'TAGC')) AS seq, qual_text || reverse(qual_text) AS qual_text FROM reads")
def joined_mates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads and their reverse complements as mates, joined by place and then one after the other."""
    rows = reads(spark, sf_dir).select("ordinal", F.col("ordinal").cast("string").alias("id"), "seq", "qual_text")
    both = D.mates(rows, rows.select("ordinal", "id", S.reverse_complement(F.col("seq")).alias("seq"), F.reverse("qual_text").alias("qual_text")))
    read = lambda n: F.struct(F.col("id").alias("name"), F.col(f"seq{n}").alias("seq"), S.decode_quality(F.col(f"qual_text{n}")).alias("qual"))
    out = both.select("ordinal", S.joined_reads(read(""), read("2")).alias("r")).select("ordinal", "r.*")
    return out.select("ordinal", "name", "seq", S.encode_quality(F.col("qual")).alias("qual_text"))


_MATES = f", mates AS (SELECT a.doc_id, CAST(a.tile // 2 AS INT) AS pair, a.seq AS seq1, b.seq AS seq2 FROM reads a JOIN reads b ON a.doc_id = b.doc_id AND a.tile + 1 = b.tile WHERE a.tile % 2 = 0 AND length(b.seq) = {READ})"


@query(
    READS
    + _MATES
    + """, s AS (SELECT doc_id, pair, CAST(k AS INT) AS k, list_sum(list_transform(range(1, 31), lambda i: CASE WHEN substr(seq1, CAST(7 + i AS INT), 1) = substr(seq2, CAST(7 + i + k AS INT), 1) THEN 1 ELSE -1 END)) AS score FROM mates, unnest(range(-4, 5)) AS u(k))
SELECT doc_id, pair, arg_max(k, score * 100 - abs(k) * 2 + CASE WHEN k > 0 THEN 1 ELSE 0 END) AS shift, CAST(max(score) AS INT) AS score FROM s GROUP BY ALL"""
)
def best_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shift at which the middle of a read agrees best with the next read of its document."""
    rows = reads(spark, sf_dir).select("doc_id", (F.col("tile") / 2).cast("int").alias("pair"), (F.col("tile") % 2).alias("mate"), "seq")
    both = rows.groupBy("doc_id", "pair").agg(*[F.max(F.when(F.col("mate") == k, F.col("seq"))).alias(f"seq{k + 1}") for k in (0, 1)])
    found = both.filter(F.length("seq2") == READ).withColumn("x", D.shift_of(F.col("seq1"), F.col("seq2"), 30, 4))
    return found.select("doc_id", "pair", F.col("x.offset").alias("shift"), F.col("x.score").alias("score"))


_ALLELES = "SELECT 'TR' || CASE WHEN p_size % 2 = 0 THEN 'A' ELSE 'B' END || CASE WHEN p_size % 3 = 0 THEN 'V' ELSE 'J' END || p_partkey || '*01' AS name, 'TR' || CASE WHEN p_size % 2 = 0 THEN 'A' ELSE 'B' END AS gene, CASE WHEN p_size % 3 = 0 THEN 'V' ELSE 'J' END AS region, p_brand AS species, p_type AS functionality, p_size AS refpos, p_name AS acc_nr, 'ACGT' AS seq, CAST(p_partkey AS VARCHAR) AS segment, '01' AS allele FROM part"


def part_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("TR"), F.when(F.col("p_size") % 2 == 0, "A").otherwise("B"), F.when(F.col("p_size") % 3 == 0, "V").otherwise("J"), "p_partkey", F.lit("*01"))
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("species"), name.alias("name"), F.col("p_type").alias("functionality"), F.col("p_size").alias("refpos"), F.col("p_name").alias("acc_nr"), F.lit("ACGT").alias("seq"))
    return rows.withColumn("p", S.allele_parts(F.col("name"))).select(*rows.columns, "p.*")


@query(f"WITH a AS ({_ALLELES}) SELECT species, gene, region, count(*) AS count FROM a WHERE gene = 'TRB' AND refpos IN (3, 5, 7, 9) GROUP BY ALL")
def chosen_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alleles made of the parts, chosen by attributes and counted."""
    rows = tables.restricted(part_alleles(spark, sf_dir), gene=["TRA", "TRB"], region=["V", "J"])
    return tables.allele_counts(tables.choose_alleles(tables.require(rows, gene="TRB"), gene="TRB", refpos=[3, 5, 7, 9], species=None))


@query(f"WITH a AS ({_ALLELES}) SELECT * FROM a")
def allele_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference table written and read again."""
    path = f"{shared_dir(spark)}/alleles-{uuid.uuid4().hex}"
    tables.write_alleles(part_alleles(spark, sf_dir), path)
    return tables.read_reference(spark, path)


_DOTTED = AS_BASES[:23] + "." + AS_BASES[24:]
_STRICT, _LIBERAL = tables.J_ANCHOR


@query(
    READS
    + f""", v AS (SELECT 'TRBV' || doc_id || '*01' AS name, translate(l, '{LETTERS}', '{_DOTTED}') AS g FROM letters), j AS (SELECT 'TRBJ' || doc_id || '*01' AS name, translate(l, '{LETTERS}', '{AS_BASES}') AS g FROM letters WHERE length(l) > 0)
SELECT name, 312 - (length(substr(g, 1, 312)) - length(replace(substr(g, 1, 312), '.', ''))) AS refpos, replace(g, '.', '') AS seq FROM v WHERE length(g) > 0
UNION ALL SELECT name, CASE WHEN regexp_matches(g, '{_STRICT}') THEN strpos(g, regexp_extract(g, '{_STRICT}')) ELSE strpos(g, regexp_extract(g, '{_LIBERAL}')) END - 1, g FROM j WHERE regexp_matches(g, '{_LIBERAL}')"""
)
def gapped_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors of gapped germline records made of whole documents: every text as V, and as J those that have an anchor."""
    letters = spread(table(spark, sf_dir, "documents")).select("doc_id", F.regexp_replace(F.lower("text"), "[^a-z]", "").alias("l")).filter("length(l) > 0")
    record = lambda kind: F.concat(F.lit(f"X|TRB{kind}"), "doc_id", F.lit("*01|Homo sapiens|(F)")).alias("name")
    v = letters.select(record("V"), F.translate("l", LETTERS, _DOTTED).alias("seq"))
    j = letters.select(record("J"), F.translate("l", LETTERS, AS_BASES).alias("seq")).filter(F.col("seq").rlike(_LIBERAL))
    return tables.alleles_from_fasta(v.unionByName(j)).select("name", "refpos", "seq")


@query(READS + "SELECT 'd' || doc_id AS name, upper(l) AS seq FROM letters WHERE length(l) > 0")
def fasta_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' letters written as FASTA records in lines of 60, and read again by ranges."""
    path = f"{shared_dir(spark)}/fasta-{uuid.uuid4().hex}"
    letters = spread(table(spark, sf_dir, "documents")).select("doc_id", F.regexp_replace(F.lower("text"), "[^a-z]", "").alias("l")).filter("length(l) > 0")
    files.write_fasta(letters.select(F.concat(F.lit("d"), "doc_id").alias("name"), F.regexp_replace("l", "(.{60})", "$1\n").alias("seq")), path)
    return files.read_fasta(spark, path).select("name", "seq")


#: Stands in for an aligner: reads the FASTA file, then FASTQ, and places each read at an allele that its length chooses.
STUB_ALIGNER = """awk 'NR == FNR { if (/^>/) a[n++] = substr($0, 2); next } FNR %% 4 == 1 { name = substr($0, 2) } FNR %% 4 == 2 { s = $0 }
FNR %% 4 == 0 { print name "\t0\t" a[length(s) %% n] "\t1\t50\t" length(s) "M\t*\t0\t0\t" s "\t" $0 }' %(ref_fn)s -"""


@query(
    READS
    + """, v AS (SELECT list(name ORDER BY name) AS names FROM (SELECT 'TRBV' || n_nationkey || '*01' AS name FROM nation))
SELECT ordinal || ':r' AS read, names[CAST(length(seq) % len(names) AS INT) + 1] AS allele, length(seq) || 'M' AS cigar, seq, qual_text FROM reads, v"""
)
def piped_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reads through an aligner command, one process for each partition."""
    rows = reads(spark, sf_dir).select(F.col("ordinal").alias("uid"), F.lit("r").alias("id"), "seq", "qual_text")
    sam = aligners.command_aligner(alleles(spark, sf_dir), "V", aligners.Command(STUB_ALIGNER))(rows)
    return sam.select(F.col("QNAME").alias("read"), F.col("RNAME").alias("allele"), F.col("CIGAR").alias("cigar"), F.col("SEQ").alias("seq"), F.col("QUAL").alias("qual_text"))


@query(READS + "SELECT CAST(ordinal AS VARCHAR) AS id, 'x y' AS desc, seq, qual_text, row_number() OVER (ORDER BY ordinal) - 1 AS number FROM reads")
def fastq_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads written as FASTQ in order, compressed by none, read again and numbered."""
    path = f"{shared_dir(spark)}/fastq-{uuid.uuid4().hex}"
    # documents are sorted, not their reads, which are more and longer
    rows = reads_of(table(spark, sf_dir, "documents").orderBy("doc_id"))
    files.write_fastq(rows.select(F.col("ordinal").cast("string").alias("id"), F.lit("x y").alias("desc"), "seq", "qual_text"), path)
    return files.read_fastq(spark, path, encoding=None).select("id", "desc", "seq", "qual_text", F.col("ordinal").alias("number"))


@query(READS + "SELECT CAST(CASE WHEN min(least) < 59 THEN 33 ELSE 64 END AS INT) AS phred_offset FROM (SELECT list_min(list_transform(range(1, length(qual_text) + 1), lambda i: ascii(substr(qual_text, CAST(i AS INT), 1)))) AS least FROM reads ORDER BY ordinal LIMIT 100)")
def sniffed_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality encoding, by the first reads."""
    found = files.phred_offset(reads(spark, sf_dir))
    return spark.range(1).select(F.lit(found).alias("phred_offset"))


@query(READS + "SELECT 'v' AS v_call, 'j' AS j_call, seq, n AS orig_count, n AS count, 3 AS v_end, 7 AS j_start, q.qual_text AS qual_text FROM clones JOIN quals q USING (seq)")
def cloneset_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clone set written in the older format and read again."""
    path = f"{shared_dir(spark)}/cloneset-{uuid.uuid4().hex}"
    tables.write_cloneset(K.build(reads(spark, sf_dir).drop("qual")).select("*", F.lit("v").alias("v_call"), F.lit("j").alias("j_call"), F.lit(3).alias("v_end"), F.lit(7).alias("j_start")), path)
    return tables.read_cloneset(spark, path).withColumn("qual_text", S.encode_quality(F.col("qual"))).drop("qual")


_EMPTY = ", ".join(f"'' AS {c}" for c in ("sequence", "productive", "v_call", "d_call", "j_call", "sequence_alignment", "germline_alignment", "v_cigar", "d_cigar", "j_cigar", "vj_in_frame", "stop_codon", "cdr3_start", "cdr3_end", "v_sequence_end", "j_sequence_start", "v_junction_end", "j_junction_start"))


@query(READS + f"SELECT CAST(row_number() OVER (ORDER BY n DESC, seq) AS VARCHAR) AS sequence_id, 'F' AS rev_comp, seq AS junction, {_AA} AS junction_aa, CAST(n AS VARCHAR) AS duplicate_count, q.scores AS junction_quality_scores, CAST(least AS VARCHAR) AS junction_minimum_quality_score, {_EMPTY} FROM clones JOIN quals q USING (seq)")
def converted_clones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored clone set as AIRR rows without a reference."""
    return tables.converted(K.build(reads(spark, sf_dir).drop("qual")))


@query(READS + ", " + _pairs_sql(2) + "SELECT s, other, distance FROM both_ways WHERE s IN (SELECT seq FROM reads WHERE source = 'src1')")
def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours of one source's reads among all."""
    rows = reads(spark, sf_dir)
    return J.neighbours(rows, rows.filter("source = 'src1'"), 2)


@query(
    READS
    + """, p AS (SELECT DISTINCT substr(seq, 1, CAST(k AS INT)) AS s FROM reads, unnest([11, 12]) AS u(k) WHERE length(seq) >= k), h AS (SELECT s, length(s) AS len, substr(s, 1, CAST(length(s) // 2 AS INT)) AS a, substr(s, CAST(length(s) // 2 + 1 AS INT)) AS b FROM p)
SELECT DISTINCT a, b, distance FROM (SELECT x.s AS a, y.s AS b, CAST(hamming(x.s, y.s) AS INT) AS distance FROM h x JOIN h y ON x.len = y.len AND x.a = y.a WHERE x.s < y.s UNION ALL SELECT x.s, y.s, CAST(hamming(x.s, y.s) AS INT) FROM h x JOIN h y ON x.len = y.len AND x.b = y.b WHERE x.s < y.s) WHERE distance <= 1"""
)
def prefix_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of the reads' beginnings of 11 and 12 bases that differ in one."""
    return J.prefix_pairs(reads(spark, sf_dir), 1, F.col("length").isin(11, 12))
