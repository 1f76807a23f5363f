import pytest
from pyspark.sql import functions as F

from termloom.functions.fixed_values import STEM_EXCEPTIONS, STOPWORDS
from termloom.functions.html import anchor_hrefs, html_text
from termloom.functions.text import strip_links, strip_punctuation
from termloom.functions.urls import canonical_url, is_followable, resolve_url
from termloom.operators.analysis import analyze
from termloom.operators.stems import stem_of


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_stopwords():
    assert len(STOPWORDS) == len(set(STOPWORDS)) == 124
    assert not {"and", "or", "not"} & set(STOPWORDS)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("see https://a.b/c?d now", "see   now"),
        ("httpd stays http bare", "  stays http bare"),
        ("xhttps://y\nz", "x \nz"),
        ("HTTP://A", "HTTP://A"),
    ],
)
def test_links(spark, text, expected):
    assert one(spark, strip_links(F.lit(text))) == expected


def test_punctuation(spark):
    assert one(spark, strip_punctuation(F.lit("a.b\n\tc_d e-f (ʌ) ½"))) == "a b c_d e-f  ʌ  ½"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("The storm, and THE Storm!", ["storm", "and", "storm"]),
        ("don't - well-known _x_", ["-", "well-known", "_x_"]),
        ("http://x.y/z only links https://q", ["links"]),
        ("", []),
        ("the of", []),
        ("ΟΔΟΣ Χάλλεϋ", ["οδος", "χάλλεϋ"]),
        ("or not and nor", ["or", "not", "and"]),
        ("line\nbreak\ttab", ["line", "break", "tab"]),
    ],
)
def test_prepared_terms(spark, text, expected):
    assert analyze(spark, [text])[0] == expected


STEMS = """
consigned consign consigning consign consistency consist consolation consol consolatory consolatori knaves knave
kneaded knead knightly knight knitted knit knives knive knocks knock knotty knotti hurricanes hurrican katrina katrina
ties tie cries cri gas gas this this kiwis kiwi gaps gap luxuriated luxuri hopping hop hoped hope sized size
feed feed agreed agre happy happi enjoy enjoy by by say say relational relat conditional condit rationalize ration
generously generous communication communic inning inning proceed proceed exceeds exceed national nation
consign consign consignment consign consist consist consisted consist consistent consist consistently consist
consisting consist consists consist consolations consol console consol consoled consol consoles consol
consolidate consolid consolidated consolid consolidating consolid consoling consol consolingly consol consols consol
consonant conson consort consort consorted consort consorting consort conspicuous conspicu conspicuously conspicu
conspiracy conspiraci conspirator conspir conspirators conspir conspire conspir conspired conspir conspiring conspir
constable constabl constables constabl constance constanc constancy constanc constant constant
knack knack knackeries knackeri knacks knack knag knag knave knave knavish knavish kneading knead knee knee kneel kneel
kneeled kneel kneeling kneel kneels kneel knees knee knell knell knelt knelt knew knew knick knick knif knif knife knife
knight knight knights knight knits knit knitting knit knob knob knobs knob knock knock knocked knock knocker knocker
knockers knocker knocking knock knopp knopp knot knot knots knot
caresses caress ponies poni cats cat agreed agre plastered plaster bled bled motoring motor sing sing conflated conflat
troubled troubl falling fall hissing hiss failing fail filing file valenci valenc digitizer digit radicalli radic
differentli differ vileli vile analogousli analog predication predic operator oper feudalism feudal decisiveness decis
hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic
formative format formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv
allowance allow inference infer airliner airlin adjustable adjust defensible defens irritant irrit replacement replac
adjustment adjust dependent depend adoption adopt communism communism activate activ effective effect bowdlerize bowdler
activate activ rate rate cease ceas controll control roll roll yield yield youth youth boy boy dog- dog- - - is is
""".split()


def test_stems(spark):
    pairs = dict(zip(STEMS[::2], STEMS[1::2])) | STEM_EXCEPTIONS
    rows = spark.createDataFrame([(w,) for w in pairs], "term string").select("term", stem_of(F.col("term")).alias("s"))
    assert {r["term"]: r["s"] for r in rows.collect()} == pairs


def test_stem_of_null_and_analysis(spark):
    assert one(spark, stem_of(F.lit(None).cast("string"))) is None
    assert analyze(spark, ["The Hurricanes and knotty knives"], stem=True)[0] == ["hurrican", "and", "knotti", "knive"]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>a<br>b</p><!-- c --><script>var d='<p>';</script><style>e{}</style>f", " a b f"),
        ("x &amp;copy; &copy; &#65;&#x42; &nosuch; & y &eacute;", "x &copy; © AB &nosuch; & y é"),
        ("don&apos;t &copy y &hellip; &notit; &#8364; &amp &ampx", "don't © y … ¬it; € & &x"),
        ("<i title='a>b'>c</i><b title=\"d>'e\">f</b><u title=don't>g</u>", "c f g"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("&#0;&#xD800;", "��"),
    ],
)
def test_html_text(spark, html, expected):
    text = one(spark, html_text(F.lit(html)))
    assert " ".join(text.split()) == " ".join(expected.split())


def test_hrefs(spark):
    html = """<a href="/a">x</a><A class=b HREF='c&amp;d'>y</A><a href=e>z</a><a name="n">n</a><abbr href="no">
    <!-- <a href="hidden"> --><script>"<a href='js'>"</script><a data-href="no2" href="">e</a><a
    href = "#f">f</a>"""
    assert one(spark, anchor_hrefs(F.lit(html))) == ["/a", "c&d", "e", "", "#f"]


@pytest.mark.parametrize(
    "base, href, expected",
    [
        ("http://a.com/x/y.html", "z", "http://a.com/x/z"),
        ("http://a.com/x/y.html", "../z", "http://a.com/z"),
        ("http://a.com/x/", "./z/../w?q=1#f", "http://a.com/x/w?q=1#f"),
        ("http://a.com", "z", "http://a.com/z"),
        ("http://a.com/x/y", "//b.org/k", "http://b.org/k"),
        ("http://a.com/x/y?p=1", "?q=2", "http://a.com/x/y?q=2"),
        ("http://a.com/x/y", "/r", "http://a.com/r"),
        ("http://a.com/x/y", "javascript:void(0)", "javascript:void(0)"),
        ("http://a.com/x/y", "https://b.org/a/../b", "https://b.org/a/../b"),
        ("http://a.com/x/y", "../../../z", "http://a.com/z"),
        ("http://a.com/x/y/z", "..", "http://a.com/x/"),
        ("http://a.com/x/y/z", ".", "http://a.com/x/y/"),
        ("http://a.com/x/y?u=/a/b", "z?v=../w", "http://a.com/x/z?v=../w"),
        ("http://a.com/x/y", "/p/./q/../r", "http://a.com/p/r"),
        ("http://a.com?q", "?r", "http://a.com?r"),
    ],
)
def test_resolve(spark, base, href, expected):
    assert one(spark, resolve_url(F.lit(base), F.lit(href))) == expected


def test_follow_and_cut(spark):
    kept = [one(spark, is_followable(F.lit(h))) for h in ("#a", "mailto:x", "", "b#c", "?d", "Mailto:x")]
    assert kept == [False, False, False, True, True, True]
    assert one(spark, canonical_url(F.lit("http://a/b?c#d"))) == "http://a/b"
    assert one(spark, canonical_url(F.lit("http://a/b#c?d\ne"))) == "http://a/b"
