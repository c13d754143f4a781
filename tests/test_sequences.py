"""Column functions, sources and clone operators on small cases with literal results."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vdjspark.functions import airr, cigar
from vdjspark.functions import sequences as S
from vdjspark.jobs import repertoire
from vdjspark.operators import clones as K
from vdjspark.operators import demultiplex as D
from vdjspark.operators import error_rates as E
from vdjspark.operators import merges as M
from vdjspark.operators import similarity as J
from vdjspark.sources import sequence_files as files
from vdjspark.sources import tables


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).head()


def test_strings(spark):
    got = one(spark, rc=S.reverse_complement(F.lit("ACGTNR")), aa=S.translate_codons(F.lit("ATGTAANCCTT")), none=S.translate_codons(F.lit("AT")), parts=S.allele_parts(F.lit("TRBV10-2*01")), umi=S.umi_parts(F.lit("UMI:R1:ACGT:II:I")))
    assert (got.rc, got.aa, got.none) == ("RNACGT", "M*?", "")
    assert tuple(got.parts) == ("TRB", "V", "10-2", "01") and tuple(got.umi) == ("R1", "ACGT", "II:I")


def test_qualities(spark):
    text = "".join(chr(33 + q) for q in range(42))
    got = one(spark, q=S.decode_quality(F.lit(text)), back=S.encode_quality(S.decode_quality(F.lit(text))), p=S.phred_to_probability(F.lit(20)), n=S.zero_unknown(F.lit("ANC"), F.array(*map(F.lit, (5, 6, 7)))))
    assert (got.q, got.back, got.n) == (list(range(42)), text, [5, 0, 7]) and got.p == pytest.approx(0.01)
    with pytest.raises(PySparkException, match=r"Quality score \(42\) not in \[0, 41\]"):
        one(spark, q=S.decode_quality(F.lit("K")))


def test_cigar(spark):
    got = one(spark, span=cigar.intervals(F.lit("5S10M1D5M2I10S"), F.lit(4)))
    assert tuple(got.span) == (5, 22, 4, 20)
    at = [cigar.query_position(F.lit("3S3M3D8M3I1M5S"), F.lit(0), F.lit(t)) for t in range(-1, 17)]
    got = one(spark, at=F.array(*at)).at
    assert got == [None, 3, 4, 5, None, None, None, 6, 7, 8, 9, 10, 11, 12, 13, 17, None, None]


def test_error_stats(spark):
    ref = "A" * 5 + "CCC" + "GG" + "TTTTTTTT" + "A" + "CC"
    seq = "NNN" + "CCA" + "TTTTTTTC" + "GGG" + "A"
    got = one(spark, s=cigar.error_stats(F.lit("3S3M2D8M3I1M"), F.lit(6), F.lit(seq), F.lit(ref)))
    assert tuple(got.s) == (15, 2, 3, 2, 5, 19)


def test_fastq_and_fasta(spark, tmp_path):
    (tmp_path / "r.fq").write_text("@r1 one two\nACGN\n+\nIIII\n@r2\nTT\n+\n!J\n")
    reads = files.read_fastq(spark, str(tmp_path / "r.fq"))
    assert [tuple(r) for r in reads.orderBy("ordinal").select("id", "desc", "seq", "qual").collect()] == [("r1", "one two", "ACGN", [40, 40, 40, 0]), ("r2", "", "TT", [0, 41])]
    assert files.phred_offset(reads) == 33
    files.write_fastq(reads, str(tmp_path / "out"))
    assert files.read_fastq(spark, str(tmp_path / "out")).select("id", "seq").exceptAll(reads.select("id", "seq")).count() == 0
    (tmp_path / "cut.fq").write_text("@r1\nACG\n+\n")
    with pytest.raises(PySparkException):
        files.read_fastq(spark, str(tmp_path / "cut.fq")).collect()
    (tmp_path / "a.fa").write_text("; comment\n>x y\nac\ngt\n>z\n\n>w\nA\n")
    assert [tuple(r) for r in files.read_fasta(spark, str(tmp_path / "a.fa")).orderBy("ordinal").select("name", "seq").collect()] == [("x y", "ACGT"), ("z", ""), ("w", "A")]


def test_numbers_have_no_gaps(spark):
    got = files.numbered(spark.range(0, 1000, 1, 7).filter("id % 3 = 0")).orderBy("ordinal").collect()
    assert [r.ordinal for r in got] == list(range(334)) and [r.id for r in got] == list(range(0, 1000, 3))
    assert files.numbered(spark.range(0)).count() == 0


def test_hamming_pairs_match_all_pairs(spark):
    strings = ["".join(p) for p in itertools.product("AC", repeat=5)] + ["A", "C", "", "AAAAAA"]
    df = spark.createDataFrame([(s,) for s in [*strings, None, "AAAAA"]], "seq string")
    for d in (1, 2, 5):
        want = {(a, b, k) for a, b in itertools.combinations(sorted(set(strings)), 2) if len(a) == len(b) and (k := sum(x != y for x, y in zip(a, b, strict=True))) <= d}
        got = [tuple(r) for r in J.hamming_pairs(df, d).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    got = {tuple(r) for r in J.hamming_pairs(spark.createDataFrame([(s,) for s in ("AAAA", "AAAT", "TAAT", "TATA")], "seq string"), 1).collect()}
    assert got == {("AAAA", "AAAT", 1), ("AAAT", "TAAT", 1)}


def test_nearest_and_levenshtein(spark):
    df = spark.createDataFrame([(s,) for s in ("AAAA", "AAAT", "AATT", "CCCC", "AAA", "CCCCC")], "seq string")
    got = {tuple(r) for r in J.nearest_neighbours(df, 2).collect()}
    assert got == {("AAAA", "AAAT", 1), ("AAAT", "AAAA", 1), ("AAAT", "AATT", 1), ("AATT", "AAAT", 1)}
    got = {tuple(r) for r in J.levenshtein_pairs(df, 1, 1).collect()}
    assert got == {("AAAA", "AAA", 1), ("AAAT", "AAA", 1), ("CCCCC", "CCCC", 1)}


def test_consensus_ties(spark):
    rows = [("ACGT", [10, 20, 30, 40]), ("ACGA", [10, 20, 30, 40]), ("CCNC", [10, 21, 0, 30])]
    got = K.consensus(spark.createDataFrame([("g", *r) for r in rows], "g string, seq string, qual array<int>"), ["g"]).head()
    assert (got.seq, got.qual, got.base_count, got.mutation_count) == ("ACGN", [10, 21, 30, 0], 12, 3)


def test_junction_groups(spark):
    rows = [("ACTG", [40, 0, 41, 1]), ("ACTG", [2, 40, 3, 40]), ("AAA", [15, 20, 30]), ("AAA", [1, 2, 41]), ("ACCCA", [1] * 5), ("CTGA", [2] * 4)]
    built = K.build(spark.createDataFrame(rows, "seq string, qual array<int>"))
    got = [(r.sequence_id, r.seq, r["count"], r.qual) for r in K.ranked(built).orderBy("sequence_id").collect()]
    assert got == [(1, "AAA", 2, [15, 20, 41]), (2, "ACTG", 2, [40, 40, 41, 40]), (3, "ACCCA", 1, [1] * 5), (4, "CTGA", 1, [2] * 4)]
    assert tuple(K.totals(built).head()) == (4, 6, 23)


def test_rates(spark):
    h = spark.createDataFrame([(1, 2), (2, 1), (3, 1)], "q int, cnt long")
    assert E.lower_median(h).head()[0] == 1 and E.lower_median(h.limit(0)).head()[0] == 0
    s = spark.createDataFrame([(20, 1000, 10), (30, 1000, 1), (0, 5, 0)], "q int, n long, mm long")
    assert E.quality_slope(s).head()[0] == pytest.approx(1.0) and E.quality_slope(s.limit(0)).head()[0] == 1.0
    assert sum(E.binomial(k, 20, 0.3) for k in range(21)) == pytest.approx(1) and E.binomial(0, 5, 0.0) == 1


def clones(spark, rows):
    return M.start(spark.createDataFrame([(s, [q] * len(s), n, n) for s, n, q in rows], "seq string, qual array<int>, count long, orig_count long"))


def test_merge_by_abundance_golden(spark):
    base = "ACGTTGCAAC" * 4 + "GTACA"
    rows = [(base, 65, 30), ("T" + base[1:], 29, 30), ("TT" + base[2:], 5, 30), ("AAA" + base[3:], 1, 30)]
    rows[2] = ("C" + base[1:20] + "C" + base[21:], 5, 30) if base[20] != "C" else ("C" + base[1:20] + "G" + base[21:], 5, 30)
    rows[3] = ("G" + base[1:10] + ("G" if base[10] != "G" else "T") + base[11:30] + ("G" if base[30] != "G" else "T") + base[31:], 1, 30)
    got = M.merge_by_abundance(clones(spark, rows), 0.01).collect()
    assert [(r.seq, r["count"], r.mutations) for r in got] == [(base, 100, 42)]


def test_merge_by_quality_and_unknown(spark):
    base = "ACGTTGCAAC" * 3
    rows = [(base, 90, 40), ("C" + base[1:], 2, 5), (base[:-1] + "G", 3, 40)]
    got = {r.seq: r["count"] for r in M.merge_by_quality(clones(spark, rows), 0.01).collect()}
    assert got == {base: 92, base[:-1] + "G": 3}
    rows = [(base, 9, 40), ("N" + base[1:], 2, 5), ("NT" + base[2:], 1, 5), ("TTTN", 1, 5), ("TTTTACGTAC", 3, 9), ("NNNNACGTAC", 1, 5), ("N" * 10, 1, 5)]
    got = {r.seq: r["count"] for r in M.merge_unknown(clones(spark, rows)).collect()}
    assert got == {base: 11, "NT" + base[2:]: 1, "TTTN": 1, "TTTTACGTAC": 5}


def test_reach_follows_counts_and_rates():
    assert [M.farthest(n, 45, 0.01) for n in (1, 100, 40_000)] == [0, 2, 5] and M.farthest(1e9, 10, 0.0) == 0


def test_merges_go_on_until_none_is_left(spark):
    chain = ["ACGTTGCAAC" * 3]
    for i in range(25):
        chain.append(chain[-1][:i] + ("A" if chain[-1][i] != "A" else "C") + chain[-1][i + 1 :])
    rows = [(s, 200 - 4 * i, 5) for i, s in enumerate(chain)]
    got = M.merge_by_quality(clones(spark, rows), 0.2)
    counts = {r.seq: r["count"] for r in got.collect()}
    assert sum(counts.values()) == sum(n for _, n, _ in rows) and len(counts) < 8
    assert {r.seq: r["count"] for r in M.merge_by_quality(got, 0.2).collect()} == counts


def test_merge_indels(spark):
    base = "ACGTTGCAAC" * 3
    rows = [(base, 1000, 40), (base[1:], 2, 40), (base + "A", 2, 40), (base[2:], 1, 40)]
    got = {r.seq: r["count"] for r in M.merge_indels(clones(spark, rows), 0.001, 0.001).collect()}
    assert got[base] == 1004 and sum(got.values()) == 1005


def test_demultiplexing(spark):
    adapters = [D.Adapter("S1", "aACGTnNNNN".replace("n", "y")), D.Adapter("S2", "wCATGNNN")]
    reads = spark.createDataFrame([("a", "TTAACGTCGGTATT", "I" * 14), ("b", S_RC, "ABCDEFGHIJKLMN"), ("c", "AAAA", "IIII"), ("d", None, None)], "id string, seq string, qual_text string")
    got = {r.id.split()[0]: (r["sample"], r.umi, r.mismatches) for r in D.demultiplex(reads, adapters).collect()}
    assert got == {"a": ("S1", "GGTA", 0), "b": ("S1", "GGTA", 0)}


def plain_checkout(r1, q1, r2, q2, adapters, most):
    """One read pair by the stated rule, place by place."""

    def places(pattern, read):
        p = D.Pattern(pattern)
        at, seed = p.seed
        for start in range(len(read) - len(pattern) + 1):
            if read[start + at : start + at + len(seed)] == seed and read[start + len(pattern) - 1] in p.allowed[-1]:
                wrong = sum(c not in a for c, a in zip(read[start:], p.allowed, strict=False))
                if wrong <= most:
                    yield wrong, start

    def best_of(pattern, read):
        return min([(w, 0, s) for w, s in places(pattern, read)] + [(w, 1, s) for w, s in places(pattern, D.turned(read))], default=None)

    out = []
    for k, a in enumerate(adapters):
        both = [(m[0], swap, m) for swap, read in ((0, r1), (1, r2)) if (m := best_of(a.pattern, read))]
        if not both:
            continue
        wrong, swap, (_, rc, start) = min(both, key=lambda x: x[:2])
        x, y = ((r2, q2), (r1, q1)) if swap else ((r1, q1), (r2, q2))
        if rc:
            x, y = [(D.turned(s), q[::-1]) for s, q in (x, y)]
        umi = D.Pattern(a.pattern).umi(*x, start)
        slave_wrong = most + 1
        if a.slave:
            if not (m := best_of(a.slave, y[0])):
                continue
            slave_wrong = m[0]
            more = D.Pattern(a.slave).umi(*((D.turned(y[0]), y[1][::-1]) if m[1] else y), m[2])
            umi = umi[0] + more[0], umi[1] + more[1]
        out.append(((wrong, slave_wrong, k), (a.sample, *umi, *x, wrong, *y)))
    return min(out)[1] if out else None


def test_demultiplexing_of_mates(spark):
    adapters = [D.Adapter("S1", "yaACGTnNNNN".replace("n", "r")), D.Adapter("S2", "wCATGNNN", "rGGTAyNN"), D.Adapter("S3", "wCATGNNN", "yTTACrNN")]
    rng = random.Random(3)
    parts = ["TAACGTACCCC", "ACATGTTT", "AGGTACGG", "CTTACATT", "GGGGCATG", "ACGT"]
    rows = []
    for i in range(300):
        a, b = ("".join(rng.choice(parts) if rng.random() < 0.3 else rng.choice("ACGTN") for _ in range(14)) for _ in "ab")
        rows.append((i, f"r{i}", a, "".join(chr(40 + j % 30) for j in range(len(a))), b, "".join(chr(70 - j % 30) for j in range(len(b)))))
    first = spark.createDataFrame([r[:4] for r in rows], "ordinal long, id string, seq string, qual_text string")
    second = spark.createDataFrame([(r[0], r[1], *r[4:]) for r in rows], "ordinal long, id string, seq string, qual_text string")
    found = D.demultiplex(D.mates(first, second), adapters)
    got = {r.id.split()[0]: (r["sample"], r.umi, r.umi_qual, r.seq, r.qual_text, r.mismatches, r.seq2, r.qual_text2) for r in found.collect()}
    want = {r[1]: x for r in rows if (x := plain_checkout(*r[2:], adapters, 2))}
    assert got == want and {x[0] for x in want.values()} == {"S1", "S2", "S3"}
    assert {(r.qualifier, " UMI:R2:" in r.id) for r in D.each_mate(found).collect()} == {("R1", False), ("R2", True)}
    with pytest.raises(PySparkException, match="aren't mates"):
        D.mates(first, second.withColumn("id", F.lit("x"))).collect()
    assert D.read_adapters("S1\tACGT\nS2\tAcgt\tGgta\n\nrest") == [D.Adapter("S1", "ACGT"), D.Adapter("S2", "Acgt", "Ggta")]


def test_consensus_reads_are_kept_or_discarded(spark, tmp_path):
    base = "ACGTTGCAACGGTTAACCGGTATCAGTCAG"
    rows = [(0, "a UMI:R1:AA:I:", base + "AC"), (1, "b UMI:R1:AA:II", base + "AC"), (2, "c UMI:R1:AA:II", base[::-1] + "GG"), (3, "d UMI:R12:CC:II", "ACGT")]
    reads = spark.createDataFrame([(o, i.split()[0], i.split()[1], s, [30] * len(s)) for o, i, s in rows], "ordinal long, id string, desc string, seq string, qual array<int>")
    kept, discarded = D.consensus_reads(reads)
    assert [tuple(r)[:2] for r in kept.collect()] == [("UMI:R1:AA:1/2:2", base + "AC")]
    assert {tuple(r)[:2] for r in discarded.collect()} == {("UMI:R1:AA:2/2:1", base[::-1] + "GG"), ("d UMI:R12:CC:II", "ACGT")}
    files.write_fastq(kept, str(tmp_path / "kept"))
    assert files.read_fastq(spark, str(tmp_path / "kept")).head().id == "UMI:R1:AA:1/2:2"
    with pytest.raises(PySparkException, match="unknown qualifier R9"):
        [x.collect() for x in D.consensus_reads(reads.withColumn("desc", F.lit("UMI:R9:AA:II")))]


S_RC = "AATACCGACGTTAA"


def test_umi_groups(spark):
    base = "ACGTTGCAACGGTTAACCGGTATCAGTCAG"
    rows = [("R1", "AA", 0, base + "AC", [30] * 32), ("R1", "AA", 1, base + "AC", [20] * 32), ("R1", "AA", 2, base[:15] + ("A" if base[15] != "A" else "C") + base[16:] + "AC", [10] * 32), ("R1", "AA", 3, base[::-1] + "GG", [10] * 32), ("R1", "CC", 4, base, [9] * 30)]
    reads = spark.createDataFrame(rows, "qualifier string, umi string, ordinal long, seq string, qual array<int>")
    got = K.subgroup_ranks(D.umi_consensus(reads), ["qualifier", "umi"])
    assert {(r.umi, r.rank, r["of"], r["count"], r.seq) for r in got.collect()} == {("AA", 1, 2, 3, base + "AC"), ("AA", 2, 2, 1, base[::-1] + "GG"), ("CC", 1, 1, 1, base)}
    assert D.best_shift("ACTG", "AAACTG", 4, 4) == (2, 4)


@pytest.mark.parametrize("chunk", [3, 10_000])
def test_umi_groups_compare_every_read(spark, chunk):
    rng = random.Random(5)
    roots = ["".join(rng.choices("ACGT", k=45)) for _ in range(7)]
    seqs = {roots[i % 7][: rng.choice((45, 45, 41))] for i in range(7)}
    for i in range(70):
        s = list(rng.choice(roots))
        for _ in range(rng.randrange(6)):
            s[rng.randrange(45)] = rng.choice("ACGTN")
        seqs.add("".join(s)[rng.randrange(4) :])
    order = sorted(seqs)
    rng.shuffle(order)
    want = plain_umi(order, 30, 4, 20, 24)
    fast = D.Leaders(30, 4, 24)
    assert all(fast.shift(fast.coded(a), fast.coded(b)) == D.best_shift(a, b, 30, 4) for a in order[:40] for b in order[:40])
    reads = spark.createDataFrame([("R1", "AA", i, s, [30] * len(s)) for i, s in enumerate(order)], "qualifier string, umi string, ordinal long, seq string, qual array<int>")
    got = D.umi_consensus(reads, chunk=chunk).collect()
    assert len(want) > 6 and {(r.ordinal, r["count"], r.seq) for r in got} == {(min(x), len(x), seq) for x, seq in want}


def plain_umi(order, k, most, offset_score, merge_score):
    """Reads of one group, each once, in order -> (numbers of the members, consensus) of each subgroup, by the stated rule."""

    def consensus(members):
        seen = {}
        for i, off in members:
            for p, c in enumerate(order[i]):
                seen.setdefault(p + off, []).append(c)
        out = ""
        for p in sorted(seen):
            n = {b: seen[p].count(b) for b in "ACGT"}
            top = [b for b in n if n[b] == max(n.values())]
            out += top[0] if len(top) == 1 else "N"
        return out

    leaders = []
    for i, s in enumerate(order):
        if not any(D.best_shift(s, order[j], k, most)[1] >= merge_score for j in leaders):
            leaders.append(i)
    heads, at = {j: order[j] for j in leaders}, {}
    for _ in range(2):
        for i, s in enumerate(order):
            found = [(-score, j, off) for j, h in heads.items() for off, score in [D.best_shift(s, h, k, most)] if score >= merge_score]
            if found:
                score, j, off = min(found)
                at[i] = j, off if -score >= offset_score else 0
            else:
                at.setdefault(i, (i, 0))
        groups = {}
        for i, (j, off) in at.items():
            groups.setdefault(j, []).append((i, off))
        heads = {j: consensus(members) for j, members in groups.items()}
    return [([i for i, _ in members], heads[j]) for j, members in groups.items()]


def test_umi_reads_go_to_the_best_leader(spark):
    base = "ACGTTGCAACGGTTAACCGGTATCAGTCAG"
    turn = lambda s, at: "".join("CGTA"["ACGT".index(c)] if i in at else c for i, c in enumerate(s))
    near, between = turn(base, (2, 8, 14, 20)), turn(base, (8, 14, 20))
    assert [D.best_shift(*x, 30, 4)[1] for x in ((near, base), (between, base), (between, near))] == [22, 24, 28]
    rows = [(base, 5), (near, 3), (between, 1)]
    reads = [("R1", "AA", i * 10 + k, s, [30] * 30) for i, (s, n) in enumerate(rows) for k in range(n)]
    got = D.umi_consensus(spark.createDataFrame(reads, "qualifier string, umi string, ordinal long, seq string, qual array<int>")).collect()
    assert sorted((r["count"], r.seq) for r in got) == [(4, near), (5, base)]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_umi_consensus_known_by_hand(spark, order):
    one = "AGGCTTGTGCGTGACAGATAAAGCGCTGAGCTGAGCTCTG"
    seqs = [one, "TGTGCGTGACAGATAAAGCGCTGAGCTG", "ACCAAGGCTTGTGCGTGACAGATAAAGCGCTGAGCT"]
    rows = [("R1", "A", i, seqs[j], [40] * len(seqs[j])) for i, j in enumerate(order)] + [("R1", "T", 9, "ACCCCAAAAAGGTGGTG", [40] * 17), ("R1", "T", 10, "AACCCCAAAAAGGGGG", [40] * 16)]
    reads = spark.createDataFrame(rows, "qualifier string, umi string, ordinal long, seq string, qual array<int>")
    got = {r.umi: r for r in D.umi_consensus(reads, k=15, most_shift=10, least_offset_score=0, least_merge_score=0).collect()}
    assert len(got) == 2
    assert (got["A"].seq, list(got["A"].qual), got["A"]["count"], got["A"].base_count, got["A"].mutation_count) == ("ACCA" + one, [40] * 44, 3, 104, 0)
    assert (got["T"].seq, list(got["T"].qual), got["T"]["count"], got["T"].base_count, got["T"].mutation_count) == ("AACCCCAAAAAGGNGGTG", [40] * 13 + [0] + [40] * 4, 2, 33, 1)


def test_airr(spark):
    alleles = spark.createDataFrame([("TRBV1*01", 39, "A" * 36 + "TGT" + "AAAA"), ("TRBJ1*01", 10, "C" * 10 + "TTT" + "C" * 30)], "name string, refpos int, seq string")
    clone = spark.createDataFrame([(1, "TGTAAACCCTTT", [30] * 12, 7, "TRBV1*01", "TRBJ1*01", 4, 8)], "sequence_id long, seq string, qual array<int>, count long, v_call string, j_call string, v_end int, j_start int")
    got = airr.rearrangements(clone, alleles).head().asDict()
    assert tuple(got) == airr.COLUMNS
    assert (got["productive"], got["cdr3_start"], got["cdr3_end"], got["junction_aa"], got["duplicate_count"]) == ("T", "40", "45", "CKPF", "7")
    assert airr.rearrangements(clone).head()["sequence"] == ""


def test_alleles_from_fasta(spark):
    v = "." * 12 + "A" * 300 + "TGT"
    fasta = spark.createDataFrame([(f"X1|TRBV1*01|Homo sapiens|F", v), ("X2|TRBJ1*01|Homo sapiens|(F)", "ACTTTGGAAAAGGA")], "name string, seq string")
    got = {r.name: (r.region, r.refpos, r.functionality) for r in tables.alleles_from_fasta(fasta).collect()}
    assert got == {"TRBV1*01": ("V", 300, "F"), "TRBJ1*01": ("J", 2, "F")}


def sam(name, flag, ref, pos, cigar, seq, qual="I"):
    return (name, flag, ref, pos, 40, cigar, "*", 0, 0, seq, qual * len(seq))


def germline(spark):
    """V: bases, Cys, four bases; J: four bases, Phe, the rest."""
    return spark.createDataFrame([("TRBV1*01", 36, "ACGGTC" * 5 + "CAG" + "TGT" + "GCCA"), ("TRBV2*01", 36, "ACGGTA" * 5 + "CAG" + "TGT" + "GCCA"), ("TRBJ1*01", 4, "GAAC" + "TTT" + "GGGCCC" * 4)], "name string, refpos int, seq string")


def repertoire_pairs(spark, rows):
    """(junction between the anchors, V, number of reads, quality) -> aligned pairs."""
    out, uid = [], 0
    for middle, v, n, q in rows:
        v_ref = ("ACGGTC" if v == 1 else "ACGGTA") * 5 + "CAGTGTGCCA"
        seq = v_ref[-20:] + middle + "GAACTTTGGGCCCGGG"
        rest = seq[20:]
        for _ in range(n):
            out.append((uid, sam("r", 0, f"TRBV{v}*01", len(v_ref) - 19, f"20M{len(rest)}S", seq, q), sam("r", 0, "TRBJ1*01", 1, f"{len(middle)}S16M", rest, q)))
            uid += 1
    of = ", ".join(f"{c} {'int' if c in files.SAM_INTEGERS else 'string'}" for c in files.SAM_COLUMNS)
    return spark.createDataFrame(out, f"uid long, v struct<{of.replace(' int', ':int').replace(' string', ':string')}>, j struct<{of.replace(' int', ':int').replace(' string', ':string')}>")


@pytest.mark.parametrize("collapse", [True, False])
def test_repertoire_keeps_every_read(spark, collapse):
    rows = [("CCATTCGGCA", 1, 40, "I"), ("CCATTCGGCA", 2, 30, "I"), ("CCATTCGGAA", 1, 1, "&"), ("CCATTCGGCAA", 1, 3, "I")]
    pairs = repertoire_pairs(spark, rows)
    got = repertoire.run(pairs, germline(spark), repertoire.Options(collapse_vj=collapse))
    kept, discarded = got.kept.collect(), got.discarded.collect()
    assert sum(int(r.duplicate_count) for r in kept + discarded) == 74
    assert [r.vj_in_frame for r in discarded] == ["F"]
    counts = sorted((r.v_call, int(r.duplicate_count)) for r in kept if int(r.duplicate_count) > 1)
    assert counts == ([("TRBV1*01", 71)] if collapse else [("TRBV1*01", 41), ("TRBV2*01", 30)])
    sums = {(r.region, r.seqlen): (r.n, r.mm) for r in got.by_region.collect()}
    # V from its anchor on: 7 bases; J up to its anchor: 7
    assert sums["V", 24] == (71 * 7, 0) and sums["J", 24] == (71 * 7, 0) and sums["V", 25] == (21, 0)
    assert {(r.region, r.Q, r.n) for r in repertoire.all_qualities(got.by_quality).filter("n > 0").collect()} == {("V", 40, 73 * 7), ("J", 40, 73 * 7), ("V", 5, 7), ("J", 5, 7)}
    assert repertoire.alignment_dump(pairs).count() == 74


def test_aligners_meet_by_uid(spark):
    rows = repertoire_pairs(spark, [("CCATTCGGCA", 1, 3, "I"), ("CCATTCGGAA", 2, 2, "I")])
    reads = rows.select(F.col("uid").alias("ordinal"), F.lit("r").alias("id"), F.col("v.SEQ").alias("seq"), F.col("v.QUAL").alias("qual_text"))
    name = F.concat_ws(":", "uid", "id").alias("QNAME")
    v_aligner = lambda df: df.join(rows.select("uid", "v"), "uid").select(name, *[f"v.{c}" for c in files.SAM_COLUMNS[1:]])
    left = []

    def j_aligner(df):
        left.extend(df.select("seq").collect())
        return df.join(rows.select("uid", "j"), "uid").select(name, *[f"j.{c}" for c in files.SAM_COLUMNS[1:]])

    assert repertoire.aligned(reads, v_aligner, j_aligner).exceptAll(rows).count() == 0
    assert {r.seq for r in left} == {"CCATTCGGCAGAACTTTGGGCCCGGG", "CCATTCGGAAGAACTTTGGGCCCGGG"}


def test_bad_alignments_raise(spark):
    with pytest.raises(PySparkException, match="invalid CIGAR 5M3Q2M"):
        one(spark, x=cigar.intervals(F.lit("5M3Q2M"), F.lit(0)))
    ref, seq = F.lit("ACGTACGT"), F.lit("ACGTACGT")
    assert one(spark, x=cigar.error_stats(F.lit("5M0M"), F.lit(1), seq, ref)).x.n == 5
    with pytest.raises(PySparkException, match="no region from 6 to 2"):
        one(spark, x=cigar.error_stats(F.lit("8M"), F.lit(1), seq, ref, F.lit(6), F.lit(2)))


def test_reference_files_of_three_kinds(spark, tmp_path):
    (tmp_path / "old.fa").write_text(">TRBV1*01|refpos:39\nac\ngt\n>TRBD1*01\nAC\n")
    got = {r.name: (r.species, r.refpos, r.region, r.seq) for r in tables.read_reference(spark, str(tmp_path / "old.fa")).collect()}
    assert got == {"TRBV1*01": ("HomoSapiens", 39, "V", "ACGT"), "TRBD1*01": ("HomoSapiens", -1, "D", "AC")}
    (tmp_path / "new.fa").write_text(">X2|TRBJ1*01|Homo sapiens|(F)\nACTTTGGAAAAGGA\n")
    assert tables.read_reference(spark, str(tmp_path / "new.fa")).head().refpos == 2
    (tmp_path / "x.txt").write_text("what\n")
    with pytest.raises(ValueError):
        tables.read_reference(spark, str(tmp_path / "x.txt"))
    rows = tables.read_reference(spark, str(tmp_path / "old.fa"))
    with pytest.raises(PySparkException, match="not allowed: TRBD1"):
        tables.restricted(rows, region=["V", "J"]).collect()
    with pytest.raises(ValueError, match="no species Mouse"):
        tables.require(rows, species="Mouse")
    (tmp_path / "c.tsv").write_text("Junction nucleotide sequence\tdepth\tqvec\nACGT\t3\t1|2|3|4\n")
    r = tables.read_cloneset(spark, str(tmp_path / "c.tsv")).head()
    assert (r.seq, r["count"], r.orig_count, r.qual, r.v_call) == ("ACGT", 3, 0, [1, 2, 3, 4], None)


def test_commands(spark, tmp_path):
    (tmp_path / "r.fq").write_text("".join(f"@r{i}\nTTAACGTCGGTATT\n+\n{'I' * 14}\n" for i in range(5)) + "@x\nAAAA\n+\nIIII\n")
    (tmp_path / "b.tsv").write_text("S1\taACGTyNNNN\n")
    repertoire.main(["checkout", "--forward", str(tmp_path / "r.fq"), "--barcodes", str(tmp_path / "b.tsv"), "--out", str(tmp_path / "out")])
    found = files.read_fastq(spark, str(tmp_path / "out" / "sample=S1" / "qualifier=R1"))
    assert found.count() == 5 and found.head().desc == "UMI:R1:GGTA:IIII"
    (tmp_path / "u.fq").write_text("".join(f"@r{i} UMI:R1:AC:II\n{'ACGTTGCAACGGTTAACCGGTATCAGTCAG'}\n+\n{'I' * 30}\n" for i in range(4)))
    repertoire.main(["umi", "--reads", str(tmp_path / "u.fq"), "--out", str(tmp_path / "umi")])
    assert files.read_fastq(spark, str(tmp_path / "umi" / "consensus")).head().id == "UMI:R1:AC:1/1:4"
    clones(spark, [("ACGT", 3, 30), ("ACGA", 5, 30)]).select("seq", "qual", "count").write.parquet(str(tmp_path / "clones"))
    repertoire.main(["convert", "--clones", str(tmp_path / "clones"), "--out", str(tmp_path / "airr")])
    assert [r.duplicate_count for r in spark.read.csv(str(tmp_path / "airr"), sep="\t", header=True).collect()] == ["5", "3"]
    text = ["\t".join(map(str, x)) for p in repertoire_pairs(spark, [("CCATTCGGCA", 1, 4, "I")]).collect() for x in (p.v, p.j)]
    (tmp_path / "a.sam").write_text("\n".join(["@HD", *text]))
    tables.write_alleles(germline(spark).select(F.lit("Human").alias("species"), "name", F.lit("F").alias("functionality"), "refpos", F.lit("X").alias("acc_nr"), "seq"), str(tmp_path / "ref"))
    repertoire.main(["run", "--sam", str(tmp_path / "a.sam"), "--reference", str(tmp_path / "ref"), "--species", "Human", "--out", str(tmp_path / "run")])
    assert [r.duplicate_count for r in spark.read.csv(str(tmp_path / "run" / "results"), sep="\t", header=True).collect()] == ["4"]
    assert spark.read.csv(str(tmp_path / "run" / "Q_mm_stats"), header=True).count() == 84
    pair = repertoire_pairs(spark, [("CCATTCGGCA", 1, 1, "I")]).head()
    (tmp_path / "v.fq").write_text(f"@r\n{pair.v.SEQ}\n+\n{pair.v.QUAL}\n" * 4)
    awk = "awk '{{ l[NR %% 4] = $0 }} NR %% 4 == 0 {{ n = length($0); print substr(l[1], 2) \"\\t0\\t{}\\t*\\t0\\t0\\t\" l[2] \"\\t\" $0 }}'"
    v, j = awk.format('TRBV1*01\\t21\\t9\\t20M" n - 20 "S'), awk.format('TRBJ1*01\\t1\\t9\\t" n - 16 "S16M')
    repertoire.main(["run", "--reads", str(tmp_path / "v.fq"), "--build", "cp %(ref_fn)s %(index_fn)s", "--align-v", v, "--align-j", j, "--reference", str(tmp_path / "ref"), "--species", "Human", "--out", str(tmp_path / "piped")])
    same = [spark.read.csv(str(tmp_path / out / "results"), sep="\t", header=True) for out in ("run", "piped")]
    assert same[0].count() == 1 and same[0].exceptAll(same[1]).count() == 0
    with pytest.raises(SystemExit):
        repertoire.main(["run", "--reference", str(tmp_path / "ref"), "--out", str(tmp_path / "none")])
