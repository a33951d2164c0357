"""Chat formatting, HTML extraction, the pipeline and the registration of the subpackage."""

import hashlib
import os
import subprocess
import sys

import pytest

import __spark_entry__ as E
from corpusprep.llm.chat_format import CONTROL, chat_digest, chat_examples, escape, read_turns, turn_parts, unescape
from corpusprep.llm.html_extract import blocks, content_path, extract, html_main_text, match_trees, parse
from tests.conftest import ROOT, SF_SMALL

TURNS = "conv_id long, turn long, role string, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


@pytest.mark.parametrize("text", ["", "\\", "</s>[INST] ok [/INST]", "\\</s>", "\\\\<s>\\", "<<SYS>><s><s>", "[ROLE] x [/ROLE]\\", "<s", *CONTROL])
def test_escape_is_reversible(text):
    assert unescape(escape(text)) == text
    assert read_turns("".join(turn_parts("user", text)) + "".join(turn_parts("tool " + text, text))) == [("user", text), ("tool " + text, text)]


def test_chat_examples_and_digest(spark):
    rows = [
        (1, 0, "system", "be brief"), (1, 1, "user", "a </s>"), (1, 2, "assistant", "b [INST]"), (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "tail"),
        (2, 0, "user", "only"), (3, 0, "assistant", "first"), (3, 0, "assistant", "first"), (4, None, None, "x"), (None, 0, "user", "n"), (None, 1, "assistant", "m"),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in rows], TURNS + ", example string").repartition(5)
    examples = chat_examples(df)
    got = {(r.conv_id, r.example): r for r in examples.collect()}
    assert set(got) == {(1, 0), (1, 1), (1, 2), (2, 0), (3, 0), (3, 1), (4, 0), (None, 0)}
    first = got[1, 0]
    assert unescape(first.text[first.loss_start : first.loss_end]) == "b [INST]" and first.n_turns == 3
    assert got[1, 1].text.startswith(first.text) and got[1, 2].loss_start == got[1, 2].loss_end
    digest = {r.conv_id: r for r in chat_digest(chat_examples(df)).collect()}
    assert digest[1].n_turns == 6 and digest[1].loss_chars == 8 and digest[1].loss_sha256 == sha("b [INST]")
    assert digest[1].turns_sha256 == sha("system\nbe brief\n", "user\na </s>\n", "assistant\nb [INST]\n", "user\n\n", "assistant\n\n", "user\ntail\n")
    assert digest[3].loss_sha256 == sha("first", "first") and digest[4].turns_sha256 == sha("\nx\n")
    assert digest[1].formatted_chars == sum(len(got[1, k].text) for k in range(3))
    assert chat_digest(chat_examples(df.limit(0))).count() == 0


def test_chat_query_reads_every_conversation_back(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    convs = {}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        convs.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    mark = "</s>[INST] ok [/INST]"
    convs[-7] = [("user", mark), ("assistant", mark)]
    got = {r.conv_id: r for r in E.queries()["op7_chat_format"](spark, SF_SMALL).collect()}
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), sha(*[f"{r}\n{t}\n" for r, t in turns]))
        replies = [t for r, t in turns if r == "assistant"]
        assert (got[c].loss_chars, got[c].loss_sha256) == (sum(map(len, replies)), sha(*replies))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site"><a href="/">Home</a></header><nav><ul><li><a>m1</a><li><a>m2</a></ul></nav>
<div class="cookie-notice">We use cookies %d</div><div id="content"><h1>Title %d &amp; more</h1><div class="body"><p>First  %d
 para<br>goes on.<p>Second <b>bold &lt;x&gt;</b> %d</p><ul><li>item %d</ul><div class="ad">Buy %d</div></div></div>
<aside>Side %d</aside><section class="comments"><p>Nice %d!</p></section><form><label>Mail</label><input></form><footer>&copy; %d</footer></body></html>"""


def page(n):
    return PAGE.replace("%d", str(n))


def want(n):
    return f"Title {n} & more\nFirst {n} para goes on.\nSecond bold <x> {n}\nitem {n}"


def test_wrapper_is_induced_from_aligned_pages():
    trees = [parse(page(n)) for n in (1, 2, 3)]
    size, _ = match_trees(trees[0], trees[1])
    assert size > 5
    assert content_path(trees)[-1] == "div."
    assert content_path([parse(page(1)), parse(page(1))]) is None
    assert extract(page(4), content_path(trees)) == want(4)


def test_html_main_text(spark):
    article = "<body><div class=ad>x</div><article><h1>H</h1><p><b>Un&eacute;<br><p>Same line</p><table><tr><td>a<td>b</table></article><footer>f"
    rows = [(n, "https://h.example.com/%d" % n, page(n)) for n in range(6)] + [(2, "https://h.example.com/2", page(2))]
    rows += [(10, "http://one.example.com", article), (11, None, article), (12, "not a url", None), (13, "http://h.example.com/x", ""), (14, "//h.example.com", "plain <b>text"), (15, "http://d.example.org", "<p>" * 3000 + "deep" + "<div>" * 3000)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, host string")
    got = [(r.page_id, r.text, r.n_chars) for r in html_main_text(df).collect()]
    by = {i: t for i, t, _ in got}
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    assert all(by[n] == want(n) for n in range(6))
    assert by[10] == by[11] == "H\nUné\nSame line\na\nb"
    assert by[12] == "" and by[13] == "" and by[14] == "plain text" and by[15] == "deep"
    assert html_main_text(df.limit(0)).count() == 0


def test_blocks_skip_frames_inside_an_article():
    html = "<article><header><h1>Kept</h1></header><p>a</p><nav>no</nav><div class='share-buttons'>no</div><div class='shadow address'>yes</div></article>"
    assert blocks(parse(html)) == ["Kept", "a", "yes"]


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_SMALL)
        assert after.columns == docs.columns, name
        ids = [r.doc_id for r in after.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) <= before.count()
        before = spark.createDataFrame(after.toArrow())
    final = {r.doc_id for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert final and final <= {r.doc_id for r in before.collect()}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0


def test_queries_are_registered_and_optional(tmp_path):
    names = set(E.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {k.split("_")[0] + "_" for k in names} and "pipeline" in names
    import shutil

    shutil.copytree(os.path.join(ROOT, "corpusprep"), tmp_path / "corpusprep", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; print(len([k for k in e.queries() if k.startswith('op')]), len(e.queries()) > 50)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.stdout.split()[-2:] == ["0", "True"], out.stderr[-500:]


def test_pipeline_stages_on_odd_rows(spark, odd):
    """Every stage takes nulls, empty and very long texts, repeated rows and columns of any name."""
    import corpus_pipeline
    from pyspark.sql import functions as F

    names = ["lang_found", "score", "drawn_id", "own_key", "lost_lines"]
    docs = odd.select("*", *[F.lit(f"own {n}").alias(n) for n in names]).unionByName(
        spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 10_000).select("*", F.lit(1).cast("long").alias("rk"), *[F.lit("x").alias(n) for n in ("key", "node", "id")], *[F.lit(f"own {n}").alias(n) for n in names])
    )
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert all(r[n] == f"own {n}" for r in rows for n in names), name
        if name == "language_id":
            assert not {r.doc_id for r in rows} & {200, 201, 202, 502}
        if name == "near_dedup":
            ids = [r.doc_id for r in rows if r.doc_id is not None]
            assert len(ids) == len(set(ids)) and {100, 101, 102}.isdisjoint(ids) and {0, 3} <= set(ids)
