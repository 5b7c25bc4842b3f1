"""Near copies that share their group's smallest id."""

import corpus_pipeline

BASE = [f"w{k}" for k in range(120)]
SF = "/root/testdata/sf0.001"


def copy(k):
    return " ".join([*BASE[:k], f"x{k}", *BASE[k + 1 :]])


def test_one_document_stays_of_near_copies_under_one_id(spark, docs_of):
    other = " ".join(f"o{k}" for k in range(40))
    rows = [(5, copy(3), "en"), (5, copy(30), "en"), (5, copy(50), "en"), (7, copy(10), "en"), (5, other, "en"), (5, other, "en"), (5, "", "en"), (5, None, "en"), (9, other + " end", "en")]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs_of(rows), SF).collect()]
    near = [t for i, t in got if i == 5 and t in {copy(k) for k in (3, 30, 50)}]
    assert len(near) == 1 and [t for i, t in got if t and t.startswith("o0")] == [other]
    assert len(got) == 3 and not [i for i, _ in got if i != 5]  # the empty text, too, is one document


def test_one_document_stays_of_near_copies_without_id(spark, docs_of):
    rows = [(None, copy(3), "en"), (None, copy(30), "en"), (2, copy(50), "en"), (None, "another text of no id at all", "en")]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs_of(rows), SF).collect()]
    assert len(got) == 2 and {i for i, _ in got} == {None} and "another text of no id at all" in {t for _, t in got}


def test_thousands_of_rows_of_one_id_and_text_are_one_set(spark, docs_of):
    """Copies of a row must not multiply signatures or prefixes; the same for rows without an id."""
    from lakeloom.llm import ngram_join

    rows = [(5, copy(3), "en")] * 5000 + [(None, copy(50), "en")] * 500 + [(7, copy(10), "en"), (8, copy(90), "en"), (9, "another text altogether with a few words", "en")]
    got = ngram_join.link_components(docs_of(rows)).groupBy("doc_id", "component_id", "n_shingles").count().collect()
    assert {(r.doc_id, r.component_id): r["count"] for r in got} == {(5, None): 5000, (None, None): 500, (7, None): 1, (8, None): 1, (9, 9): 1}


def test_a_template_that_a_third_of_documents_vary(spark, docs_of):
    """All share twelve words; only those that vary nothing else are linked."""
    from lakeloom.llm import ngram_join

    template = " ".join(f"t{k}" for k in range(12))
    rows = [(k, f"{template} " + " ".join(f"v{k}x{j}" for j in range(8)), "en") for k in range(700)]
    rows += [(1000 + k, " ".join(f"o{k}x{j}" for j in range(20)), "en") for k in range(1400)]
    rows += [(5000, f"{template} " + " ".join(f"v7x{j}" for j in range(8)) + " end", "en")]
    got = {r.doc_id: r.component_id for r in ngram_join.link_components(docs_of(rows)).collect()}
    assert got == {i: 7 if i == 5000 else i for i, _, _ in rows}
