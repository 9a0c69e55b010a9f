import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from passagemill.functions.fields import first_present, state_by_word
from passagemill.functions.text import clean_code, fill_template, html_elements, terms
from passagemill.operators.extract import extract_text, extract_with
from passagemill.operators.prompt import QA_TEMPLATE, build_prompt, generate, stuff_context
from passagemill.plans.chain import stage_assign, stage_map, stage_pipe
from checks.text_models import FirstTokensModel
from passagemill.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def one(spark, value, function):
    return spark.createDataFrame([(value,)], "v string").select(function(F.col("v"))).first()[0]


def test_terms(spark):
    assert one(spark, "Ünder_score 3.14 STRASSE!", terms) == ["ünder", "score", "3", "14", "strasse"]


@pytest.mark.parametrize(
    "reply, code",
    [
        ("```python\nprint(1)\n```", "print(1)"),
        ("`x = 1`", "x = 1"),
        ("python x", "x"),
        ("plain", "plain"),
        ("", ""),
    ],
)
def test_clean_code(spark, reply, code):
    assert one(spark, reply, clean_code) == code


def test_html(spark):
    page = (
        "<html><head><style>p{}</style><SCRIPT>var a='</p>';</SCRIPT></head><body><!-- x\n<p>no</p> -->"
        "<nav><a>menu</a></nav><h1>A &amp;lt; B</h1><p>one\n <b>two</b><br>three<p></p>&nbsp;</body>"
    )
    assert one(spark, page, html_elements) == ["menu", "A &lt; B", "one two", "three"]


def test_extract_text(spark):
    files = spark.createDataFrame(
        [("a", bytearray("<p>é</p>", "utf8")), ("b", None)], "path string, content binary"
    )
    assert {tuple(r) for r in extract_text(files).collect()} == {("a", "é"), ("b", None)}
    plain = extract_text(files.where("path = 'a'"), kind="plain").first()["text"]
    assert plain == "<p>é</p>"


def test_user_parser(spark):
    def make_parser():
        return lambda data: data.decode().split("|")

    files = spark.createDataFrame(
        [("a", bytearray(b"x||y")), ("b", None)], "path string, content binary"
    )
    parsed = stage(extract_with(files, make_parser), "parsed", arrow_rows=10)
    assert {tuple(r) for r in parsed.collect()} == {("a", "x\ny"), ("b", None)}


def test_templates(spark):
    df = spark.createDataFrame([("{b}", None, 7)], "a string, b string, c int")
    fill = lambda template, **slots: fill_template(df, template, **slots).first()["prompt"]
    assert fill("no slot") == "no slot"
    assert fill("{a}-{a}-{b}-{c}") == "{b}-{b}--7"
    assert fill("{x}", x="c") == "7"
    with pytest.raises(ValueError):
        fill("{unknown}")


def test_fields(spark):
    df = spark.createDataFrame(
        [(None, "b"), ("a", "b"), (None, None)], "x string, y string"
    ).select(first_present(F.col("x"), F.col("y"), default="?").alias("v"))
    assert [r["v"] for r in df.collect()] == ["b", "a", "?"]
    states = state_by_word(F.col("v"), {"ONLINE": "ready", "PROV": "wait"}, "error")
    for state, kind in (("is Online", "ready"), ("provisioning", "wait"), ("bad", "error")):
        assert one(spark, state, lambda v: state_by_word(v, {"ONLINE": "ready", "PROV": "wait"}, "error")) == kind
    assert states is not None


HITS = [(1, 2, "second"), (1, 1, "first"), (2, 1, None), (2, 2, "only")]


def test_contexts_and_prompts(spark):
    hits = spark.createDataFrame(HITS, "query_id int, rank long, content string")
    found = {r["query_id"]: r["context"] for r in stuff_context(hits).collect()}
    assert found == {1: "first\n\nsecond", 2: "only"}
    cut = {r["query_id"]: r["context"] for r in stuff_context(hits, max_chars=3).collect()}
    assert cut == {1: "fir", 2: "onl"}
    questions = spark.createDataFrame([(1, "why?"), (3, "no hit")], "query_id int, query string")
    named = hits.withColumn("pdf_name", F.lit("a.pdf"))
    prompts = {r["query_id"]: r["prompt"] for r in build_prompt(questions, named).collect()}
    expected = lambda c, q: QA_TEMPLATE.replace("{context}", c).replace("{question}", q)
    passages = "[1] a.pdf\nfirst\n\n[2] a.pdf\nsecond"
    assert prompts == {1: expected(passages, "why?"), 3: expected("", "no hit")}


class Refusing:
    def make(self):
        def predict(prompts):
            raise RuntimeError("refused")

        return predict


def test_generate(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "")], "id int, prompt string")
    replies = {r["id"]: tuple(r["response"]) for r in generate(df, FirstTokensModel(2)).collect()}
    assert replies == {1: ("a b", None), 2: ("", None)}
    failed = generate(df, Refusing(), on_error="null").collect()
    assert {tuple(r["response"]) for r in failed} == {(None, "refused")}


def test_chain(spark):
    df = spark.createDataFrame([(1, "q", "v"), (2, "r", "w")], "id int, question string, videos string")

    def as_frame(rows):
        return rows.select("id", F.upper("videos").alias("anything"))

    mapped = df.transform(stage_map("id", c=F.upper("question"), d=as_frame))
    assert mapped.columns == ["id", "c", "d"]
    chain = stage_pipe(
        stage_map("id", c=F.upper("question"), d=as_frame), stage_assign(d=F.concat("c", "d"))
    )
    assert {tuple(r) for r in df.transform(chain).collect()} == {(1, "Q", "QV"), (2, "R", "RW")}


class Counting:
    """Replies with as many words as it may."""

    def make(self):
        def predict(prompts, max_tokens):
            return ["w " * max_tokens for _ in prompts]

        return predict


def test_reply_length_reaches_the_provider(spark):
    df = spark.createDataFrame([(1, "a")], "id int, prompt string")
    reply = generate(df, Counting(), max_tokens=3).first()["response"]["content"]
    assert reply.split() == ["w"] * 3


HTML = [
    (
        "<h2>Head</h2><table><tr><td>a</td><td>b</td></tr></table><section>x</section>",
        "Head\na\nb\nx",
    ),
    ("<nav><a>Home</a></nav><p>caf&eacute; &#8217;s &#x41;&amp;lt; &unknown; &#0; 5 &lt; 6</p>",
     "Home\ncaf\u00e9 \u2019s A&lt; &unknown; &#0; 5 < 6"),
    ("<p>one<script>var a = '<p>';</script> two<!-- no --></p><STYLE>p{}</STYLE>", "one two"),
    ("a<br/>b<hr>c<b>d</b>", "a\nb\ncd"),
]


def test_html_pages(spark):
    from passagemill.operators.extract import extract_text, extract_with

    pages = spark.createDataFrame(
        [(i, page.encode()) for i, (page, _) in enumerate(HTML)] + [(9, b"<p>bad \xff byte</p>"), (10, None)],
        "id int, content binary",
    )
    found = {r["id"]: r["text"] for r in extract_text(pages).collect()}
    assert {i: found[i] for i in range(len(HTML))} == {i: text for i, (_, text) in enumerate(HTML)}
    assert found[9] == "bad \ufffd byte" and found[10] is None

    def make_parser():
        return lambda data: data.decode("utf-8", "replace").replace(">", "<").split("<")[1:4]

    parsed = {r["id"]: r["text"] for r in extract_with(pages, make_parser).collect()}
    assert parsed[9] == "p\nbad \ufffd byte\n/p" and parsed[10] is None


def test_chunk_documents_takes_a_parser_and_a_tokenizer(spark):
    from checks.text_models import PieceCounter
    from passagemill.plans.rag import chunk_documents

    files = spark.createDataFrame([("f", b"one two. three")], "pdf_name string, content binary")
    make_parser = lambda: (lambda data: data.decode().split(" "))
    rows = chunk_documents(files, size=4, overlap=0, make_parser=make_parser, tokenizer=PieceCounter())
    assert [r["content"] for r in rows.orderBy("chunk_no").collect()] == ["one two. three"]
