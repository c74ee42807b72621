import math

import pytest
from pyspark.sql import functions as F

from residua.functions import columns as C


def values(spark, rows, kind, *exprs):
    df = spark.createDataFrame([(r,) for r in rows], f"x {kind}")
    return [tuple(r) for r in df.select(*exprs).collect()]


def one(spark, rows, fn, kind="string"):
    return [r[0] for r in values(spark, rows, kind, fn(F.col("x")))]


def test_stable_id(spark):
    got = one(spark, ["ENSG00000001.5", "ENST1", "ENSP2.1_PAR_Y", "", None, "x"], C.stable_id)
    assert got == ["ENSG00000001", "ENST1", "ENSP2.1_PAR_Y", None, None, "x"]


def test_attributes_last_wins(spark):
    got = one(spark, ['gene_id "G1"; tag "a"; level 2; tag "b";', ""], C.attributes)
    assert got == [{"gene_id": "G1", "tag": "b"}, {}]


def test_classes(spark):
    names = ["chr1", "CHRx", "KI270728.1", "NW_012345.1", "CHR_HSCHR6_MHC_MCF_PATCH", "HLA-A", "xhapx", "foo", None]
    assert one(spark, names, C.locus_class) == [
        "primary_reference", "primary_reference", "alternate_locus", "scaffold", "patch", "haplotype", "haplotype", "other", "other",
    ]
    assert one(spark, ["MPEP*", "M*PEP", "M*PEP*", "MPEP", None], C.stop_class) == [
        "terminal_stop", "internal_stop", "multiple_stops", "none", "none",
    ]
    assert one(spark, ["AC012345.1", "H3.Y", "TP53"], C.accession_like) == [True, True, False]
    assert one(spark, ["AC012345.1", "LOC12", "LINC01", "ABCP", "TP53"], C.identifier_class) == [
        "accession_like", "loc_identifier", "noncoding_like", "pseudogene_like", "standard_symbol",
    ]
    assert one(spark, ["ACDXU", "", None, "ac*", "A B"], C.sequence_issue) == ["", "empty_sequence", "empty_sequence", "*;a;c", " "]
    assert one(spark, ["M*PE*", "AB", None], C.stop_positions) == ["2,5", "", ""]
    assert one(spark, ["a | b||c", "", None], C.pipe_list) == [["a", "b", "c"], [], []]


def test_bins_and_booleans(spark):
    assert one(spark, [0, 512, 513, 5001, -1, None], C.length_bin, "int") == [0, 0, 1, 6, None, None]
    assert one(spark, ["True", "false", None, "1"], C.true_text) == [True, False, False, False]


@pytest.mark.parametrize("length,want", [(5, [0]), (10, [0]), (11, [0, 1]), (20, [0, 6, 10]), (22, [0, 6, 12])])
def test_chunk_starts(spark, length, want):
    assert one(spark, [length], lambda c: C.chunk_starts(c, 10, 4), "int") == [want]
    from residua.operators.encoder import window_starts

    assert window_starts(length, 10, 4) == want


def test_chunk_starts_rejects_bad_windows():
    with pytest.raises(ValueError):
        C.chunk_starts(F.lit(1), 10, 10)


@pytest.mark.parametrize("kind", ["uniform", "triangular", "cosine", "hann"])
def test_taper(spark, kind):
    from residua.operators.encoder import window_weights

    for n in (1, 2, 7):
        got = one(spark, [n], lambda c: C.taper(c, kind), "int")[0]
        assert got == pytest.approx(window_weights(n, kind).tolist())


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.5, 0.5], [1.0, 0.0])], "a array<double>, b array<double>, p array<double>, q array<double>")
    a, b, p, q = map(F.col, "abpq")
    r = df.select(
        C.cosine(a, b), C.max_abs_error(a, b), C.l2_distance(a, b), C.relative_l2(a, b), C.js_divergence(p, q), C.js_distance(p, q), C.entropy(p), C.all_finite(a)
    ).first()
    js = 0.5 * (0.5 * math.log(0.5 / 0.75) + 0.5 * math.log(0.5 / 0.25) + math.log(1 / 0.75))
    assert list(r) == pytest.approx([0.96, 1.0, math.sqrt(2), math.sqrt(2) / 5, js, math.sqrt(js), math.log(2), True])
    bad = spark.createDataFrame([([1.0, float("nan")],), ([None],), (None,), ([float("inf")],)], "a array<double>")
    assert [x[0] for x in bad.select(C.all_finite(F.col("a"))).collect()] == [False] * 4
