from residua.operators import reconcile as r

PRODUCTS = "product_id string, sequence_hash string, valid boolean, release string, is_mane_select boolean, is_mane_plus_clinical boolean"
RECORDS = "database string, accession string, product_id string, sequence_hash string, reviewed boolean, release string"


def test_chains_of_accessions(spark):
    chain = [(f"a{k}", f"a{k + 1}") for k in range(37)]
    rows = [*chain, ("b", "z"), ("b", "y"), ("r1", "r2"), ("r2", "r3"), ("r3", "r1"), ("into", "r1"), (None, "q"), ("q", None)]
    found = {x.accession: (x.current, x.steps) for x in r.current_accessions(spark.createDataFrame(rows, "accession string, replaced_by string")).collect()}
    assert found == {f"a{k}": ("a37", 37 - k) for k in range(37)} | {"b": ("y", 1)}  # rings lead nowhere
    assert r.current_accessions(spark.createDataFrame([], "accession string, replaced_by string")).count() == 0


def test_links_and_verdicts(spark):
    products = spark.createDataFrame(
        [("p1", "h1", True, "r1", True, None), ("p2", "h2", True, "r1", None, True), ("p3", "h1", False, "r1", None, None), ("p4", None, None, None, None, None), ("p5", "h5", True, "r1", None, None)], PRODUCTS
    )
    accessions = spark.createDataFrame([("p1", "NP_1.3"), ("p2", "NP_2")], "product_id string, accession string")
    records = spark.createDataFrame(
        [
            ("refseq", "NP_0.1", None, "other", None, "r1"),  # an older name of p1's accession
            ("refseq", "NP_2.9", None, "other", None, "r1"),
            ("uniprot", "Q1", "p1", "h1", True, "r0"),
            ("uniprot", "Q2-2", "p2", "other", False, "r1"),
            ("uniprot", "Q5", "p5", "other", None, "r0"),
            ("ensembl", "E9", None, "h2", None, None),
            ("ensembl", "E8", "nobody", None, None, None),
        ],
        RECORDS,
    )
    history = spark.createDataFrame([("NP_0", "NP_1")], "accession string, replaced_by string")
    linked = r.links(products, accessions, records, history)
    got = {(x.product_id, x.accession): (x.link, x["class"]) for x in r.classified(linked).collect()}
    assert got == {
        ("p1", "NP_0.1"): ("accession", "warning"), ("p2", "NP_2.9"): ("accession", "manual_review"), ("p1", "Q1"): ("product", "match"), (None, "Q1"): ("sequence", "match"),
        ("p2", "Q2-2"): ("product", "warning"), ("p5", "Q5"): ("product", "warning"), (None, "E9"): ("sequence", "match"),
    }
    assert {x.accession: x.products for x in linked.filter("link = 'sequence'").collect()} == {"Q1": 2, "E9": 1}  # not all pairs
    out = {x.product_id: x for x in r.evidence(products, linked).collect()}
    assert {k: x.verdict for k, x in out.items()} == {"p1": "warning", "p2": "manual_review", "p3": "mapping_failure", "p4": "mapping_failure", "p5": "warning"}
    assert out["p1"].uniprot_reviewed and out["p1"].uniprot_match and not out["p1"].refseq_match and out["p2"].in_ensembl and not out["p5"].sequence_crossvalidated
