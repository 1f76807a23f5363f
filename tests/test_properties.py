from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from termloom import boolean_search, vector_search
from termloom.operators.boolean import flag_predicate

WORDS = st.sampled_from(["storm", "wind", "rain", "and-so", "nosuch"])
EXPRESSIONS = st.recursive(
    WORDS,
    lambda inner: st.one_of(
        inner.map(lambda a: f"not {a}" if " " not in a else f"not ({a})"),
        st.tuples(inner, st.sampled_from(["and", "or"]), inner).map(lambda t: f"({t[0]}) {t[1]} ({t[2]})"),
    ),
    max_leaves=4,
)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
CONTENTS = {1: {"storm", "wind"}, 2: {"wind", "and", "rain"}, 3: set(), 4: {"and"}, 5: {"rain", "-", "well-known"}, 6: set()}


def ids(index, text):
    return {r["doc_id"] for r in boolean_search(index, text).collect()}


@FEW
@given(text=EXPRESSIONS)
def test_boolean_equals_brute_force(small, text):
    predicate, terms = flag_predicate(small, text)
    expected = {doc for doc, held in CONTENTS.items() if eval(predicate, {f: t in held for f, t in terms.items()})}  # noqa: S307
    assert ids(small, text) == expected


@FEW
@given(a=WORDS, b=WORDS)
def test_de_morgan_and_double_negation(small, a, b):
    assert ids(small, f"not ({a} and {b})") == ids(small, f"not {a} or not {b}")
    assert ids(small, f"not not {a}") == ids(small, a)


@FEW
@given(words=st.lists(st.sampled_from(["storm", "wind", "rain", "and"]), min_size=1, max_size=4), top=st.integers(0, 4))
def test_top_is_a_prefix_of_the_full_ranking(small, words, top):
    ranking = [tuple(r) for r in vector_search(small, " ".join(words), above=0).collect()]
    assert [tuple(r) for r in vector_search(small, " ".join(words), above=0, top=top).collect()] == ranking[:top]
