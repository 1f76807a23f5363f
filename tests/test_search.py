import math

import pytest
from pyspark.sql import functions as F

from termloom import (
    BadQuery,
    UnknownDocument,
    UnknownTerm,
    all_of,
    any_of,
    boolean_search,
    collection_counts,
    missing_terms,
    none_of,
    posting_lists,
    term_documents,
    term_postings,
    vector_search,
)
from termloom.operators.lookups import document_norm, document_norms
from termloom.operators.ranked import rank_all, score_sums


def ids(frame):
    return sorted(r["doc_id"] for r in frame.collect())


def ranking(frame):
    return [(r["doc_id"], round(r["score"], 6)) for r in frame.collect()]


def test_norms_and_counts(english, greek):
    norms = {r["doc_id"]: round(r["l_d"], 6) for r in english.doc_stats.collect()}
    assert norms == {"d1.txt": 11.280458, "d2.txt": 9.886062, "d3.txt": 7.029124}
    norms = {r["doc_id"]: round(r["l_d"], 6) for r in greek.doc_stats.collect()}
    assert norms == {
        "d1": 3.316625, "d2": 3.296475, "d3": 2.236068, "d4": 3.587025, "d5": 3.0, "d6": 2.236068, "d7": 3.0,
    }
    assert collection_counts(english).first().asDict() == {"n_docs": 3, "n_terms": 149}
    assert collection_counts(greek).first().asDict() == {"n_docs": 7, "n_terms": 39}


@pytest.mark.parametrize(
    "term, counts",
    [
        ("katrina", (3, 0, 3)), ("hurricane", (5, 2, 3)), ("cyclone", (2, 4, 1)), ("gulf", (1, 0, 0)),
        ("typhoon", (0, 2, 0)), ("and", (5, 5, 2)), ("or", (0, 2, 0)),
    ],
)
def test_term_counts(english, term, counts):
    found = {r["doc_id"]: r["tf"] for r in term_postings(english, [term], strict=True).collect()}
    assert tuple(found.get(f"d{i}.txt", 0) for i in (1, 2, 3)) == counts


RANKED = [
    ("english", "katrina hurricane", [("d3.txt", 0.480513), ("d1.txt", 0.330808), ("d2.txt", 0.118713)]),
    ("english", "katrina and hurricane", [("d3.txt", 0.647476), ("d1.txt", 0.491149), ("d2.txt", 0.301670)]),
    ("english", "tropical cyclone", [("d2.txt", 0.363052), ("d1.txt", 0.275583), ("d3.txt", 0.197221)]),
    ("english", "hurricane hurricane", [("d3.txt", 0.413891), ("d1.txt", 0.320683), ("d2.txt", 0.237425)]),
    ("greek", "κομήτης Χάλλεϋ", [("d2", 1.137760), ("d1", 0.816508), ("d3", 0.538433)]),
    ("greek", "πλανήτης", [("d5", 0.401324), ("d7", 0.401324), ("d4", 0.335647)]),
    ("greek", "Ήλιος αστέρας κομήτης", [("d6", 1.859909), ("d3", 0.538433), ("d2", 0.365230), ("d1", 0.363011)]),
]


@pytest.mark.parametrize("collection, text, expected", RANKED)
def test_ranked(request, collection, text, expected):
    index = request.getfixturevalue(collection)
    assert ranking(vector_search(index, text, above=0)) == expected
    assert ranking(vector_search(index, text)) == [e for e in expected if e[1] >= 0.2]
    assert ranking(vector_search(index, text, above=-1, top=2)) == expected[:2]
    assert ranking(vector_search(index, text, top=0)) == []
    ranks = {r["doc_id"]: r["rank"] for r in rank_all(vector_search(index, text, above=0)).collect()}
    assert ranks == {doc: i for i, (doc, _) in enumerate(expected, 1)}


BOOLEAN = [
    ("english", "katrina and hurricane", ["d1.txt", "d3.txt"]),
    ("english", "hurricane AND NOT katrina", ["d2.txt"]),
    ("english", "typhoon or gulf", ["d1.txt", "d2.txt"]),
    ("english", "not katrina", ["d2.txt"]),
    ("english", "not not katrina", ["d1.txt", "d3.txt"]),
    ("english", "gulf or typhoon and not katrina", ["d1.txt", "d2.txt"]),
    ("english", "(gulf or typhoon) and not katrina", ["d2.txt"]),
    ("english", "nosuchterm", []),
    ("english", "not nosuchterm", ["d1.txt", "d2.txt", "d3.txt"]),
    ("english", "not (katrina and gulf)", ["d2.txt", "d3.txt"]),
    ("greek", "κομήτης and not Χάλλεϋ", ["d3"]),
    ("greek", "πλανήτης or αστέρας", ["d4", "d5", "d6", "d7"]),
]


@pytest.mark.parametrize("collection, text, expected", BOOLEAN)
def test_boolean(request, collection, text, expected):
    found = boolean_search(request.getfixturevalue(collection), text)
    assert ids(found) == expected
    assert all(r["score"] == 1 for r in found.collect())


@pytest.mark.parametrize(
    "text, culprit",
    [
        ("the and storm", "'the'"), ("storm wind", "'wind'"), ("storm and", "end"), ("and storm", "'and'"),
        ("storm not wind", "'not'"), ("(storm", "(storm"), ("storm)", "storm)"), ("", "end"), ("storm (wind)", "'('"),
        ("f0 f1", "'f1'"),
    ],
)
def test_boolean_errors(small, text, culprit):
    with pytest.raises(BadQuery) as error:
        boolean_search(small, text)
    assert culprit in str(error.value)


def test_operators_are_whole_words(small):
    assert ids(boolean_search(small, "order or android")) == []


def test_unknown_terms(small):
    with pytest.raises(UnknownTerm, match="nosuch"):
        vector_search(small, "storm nosuch")
    assert ranking(vector_search(small, "wind nosuch", on_missing="skip", above=0)) == ranking(
        vector_search(small, "wind", above=0)
    )
    assert ranking(vector_search(small, "nosuch", on_missing="skip")) == []
    with pytest.raises(UnknownTerm, match="nosuch"):
        term_postings(small, ["nosuch"], strict=True)
    assert ids(term_documents(small, ["nosuch"])) == []
    wanted = small.spark.createDataFrame([("storm",), ("nosuch",)], "term string")
    assert [r["term"] for r in missing_terms(small, wanted).collect()] == ["nosuch"]


def test_empty_query_and_documents(small):
    assert ranking(vector_search(small, "the of", above=0)) == []
    norms = {r["doc_id"]: r["l_d"] for r in small.doc_stats.collect()}
    assert len(norms) == 6 and norms[3] == norms[6] == 0 and norms[4] == 1
    assert math.isclose(norms[1], math.sqrt((1 + math.log(3)) ** 2 + 1))
    assert ids(boolean_search(small, "not wind")) == [3, 4, 5, 6]
    assert ids(none_of(small, ["wind", "rain"])) == [3, 4, 6]
    assert ids(all_of(small, ["wind", "rain", "rain"])) == [2]
    assert ids(any_of(small, ["wind", "rain"])) == [1, 2, 5]
    assert ids(boolean_search(small, "well-known and rain")) == [5]
    assert ids(boolean_search(small, "-")) == [5]


def test_score_formula(small):
    idf_wind, idf_storm = math.log(1 + 6 / 2), math.log(1 + 6 / 1)
    total = (1 + math.log(3)) * idf_storm + idf_wind
    sums = {r["doc_id"]: r["score_sum"] for r in score_sums(small, "storm wind").collect()}
    assert math.isclose(sums[1], total) and math.isclose(sums[2], idf_wind)
    score = ranking(vector_search(small, "storm wind"))[0]
    assert score == (1, round(total / math.sqrt((1 + math.log(3)) ** 2 + 1), 6))


def test_norm_lookups(small):
    assert document_norm(small, 4) == 1
    with pytest.raises(UnknownDocument, match="77"):
        document_norm(small, 77)
    with pytest.raises(Exception, match="not in the collection: 77"):
        document_norms(small, small.spark.createDataFrame([(77,)], "doc_id bigint")).collect()


def test_posting_lists(small):
    whole = {r["term"]: [(d["doc_id"], d["tf"]) for d in r["docs"]] for r in posting_lists(small).collect()}
    assert whole["wind"] == [(1, 1), (2, 1)] and whole["storm"] == [(1, 3)]
    parts = posting_lists(small, segment_docs=2).filter("term = 'and'").select(F.explode("docs")).count()
    assert parts == 2
