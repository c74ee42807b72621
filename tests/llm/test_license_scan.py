import duckdb
import pandas as pd
import pytest

from residua.llm import license_scan

TEXTS = [
    None,
    "",
    " \n\t",
    "cc by nc cc by nc",
    "CC-BY-NC! cc by nc,4.0 (Under the MIT License) apache license, version 2.0",
    "xcc by nc cc by ncx under the mit licenses",
    "éapache license version 2 apache license version 20",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "this work is licensed under the GNU General Public License, version 3. " * 3,
    "licensed under the GNU Lesser General Public License " + "filler " * 40_000 + "permission is",
    "redistribution and use in source and binary forms with or without changes are permitted provided that the "
    "following conditions are met",
    "mit license",
    "the the the license license under version",
    "released under the mit license " * 3000,
]


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, labels string")
    return sorted((tuple(r) for r in license_scan.scan(docs).collect()), key=str)


def brute(rows):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": pd.array([r[1] for r in rows], "string")}))
    names = "doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score"
    found = con.sql(f"SELECT {names} FROM ({license_scan.oracle_sql()})").fetchall()
    return sorted((tuple(float(x) if k == 7 else x for k, x in enumerate(r)) for r in found), key=str)


def test_same_as_rows_of_words(spark):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, TEXTS[4])]
    got = run(spark, rows)
    assert got == brute(rows)
    by = {r[0]: r for r in got}
    assert by[3][2:5] == (2, 0, 3) and by[0][1:5] == (0, 0, None, None)
    assert by[4][5] == "apache-2,cc-by-nc,mit" and by[8][6] == "gpl-3" and by[7][6] == ""
    assert by[13][2] == 3000


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "plain words")]])
def test_small_tables(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_a_common_notice_is_found(spark):
    notice = "This work is licensed under the GNU General Public License, version 3."
    rows = [(i, f"text {i} " + (notice if i % 3 == 0 else "of its own")) for i in range(90)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert {r[0] for r in got if r[6] == "gpl-3"} == {i for i in range(90) if i % 3 == 0}


def test_every_notice_of_a_file_is_found(spark):
    notices = [" ".join(words for _, words, _ in license_scan.TEMPLATES), license_scan.TEMPLATES[12][1] + " . " + license_scan.TEMPLATES[8][1]]
    # Common words that the rarest 12 of the first file don't hold.
    rows = [*enumerate(notices), *((k, "licensed under the gnu general public license version 3") for k in range(2, 40))]
    got = run(spark, rows)
    assert got == brute(rows)
    by = {r[0]: r[6] for r in got}
    assert by[0] == ",".join(sorted({label for label, _, _ in license_scan.TEMPLATES}))
    assert by[1] == "bsd,gpl-3"
    rare = license_scan.rarity(spark.createDataFrame([(notices[0],)], "text string"))
    for anchors, (_, words, _) in zip(license_scan._anchors(rare), license_scan.TEMPLATES, strict=True):
        words = words.split()
        may_miss = max(k for k in range(len(words)) if (len(words) - k) / len(words) >= license_scan.MATCHED)
        assert len(anchors) == may_miss + license_scan.AGREE
