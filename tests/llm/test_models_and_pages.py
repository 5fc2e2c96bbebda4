"""Held-out accuracy of the classifiers, extraction, URL rules, top-k, and the pipeline as a whole."""

import importlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_simhash import slow_components, slow_fingerprint

import corpus_pipeline
from fieldgap.llm import quality, topk, toxicity, url_rules, wrappers
from fieldgap.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.1"
TABLES = pytest.mark.skipif(not os.path.isdir(MIDDLE), reason="test tables are not here")


def rates(spark, name, label, folder=MIDDLE):
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", label)
    rows = QUERIES[name](spark, folder).where("held_out").join(labels, "doc_id").collect()
    hit = sum(r["predicted"] == 1 and r[label] == 1 for r in rows)
    return hit / max(1, sum(r["predicted"] for r in rows)), hit / max(1, sum(r[label] for r in rows)), len(rows)


@TABLES
def test_quality_on_held_out_rows(spark):
    precision, recall, n = rates(spark, "op7_quality", "quality")
    assert n > 500 and precision > 0.98 and recall > 0.98


@TABLES
def test_toxicity_on_held_out_rows(spark):
    precision, recall, n = rates(spark, "op8_toxicity", "toxic")
    assert n > 500 and precision > 0.9 and recall > 0.8


@pytest.mark.parametrize("name", ["op7_quality", "op8_toxicity"])
def test_scores_without_usable_labels(spark, docs_of, tables, name):
    rows = [(1, "some words"), (2, None), (3, ""), (None, "no id"), (1, "some words"), (4, "long " * 100_000)]
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 1), (99, None, None)], "doc_id long, quality int, toxic int")
    folder = tables(documents=docs_of(rows), labels=labels)
    found = QUERIES[name](spark, folder).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["predicted"] == (r["score"] >= (0.3 if name == "op7_quality" else 0.7)) for r in found)


def test_labels_of_the_held_out_fold_are_not_read(spark, docs_of):
    draw = random.Random(0)
    plain = [f"plain{i}" for i in range(60)]
    rows = [(i, " ".join(draw.choices(plain, k=50)) + (" vileword" * 3 if i % 2 else "")) for i in range(400)]
    docs = docs_of(rows)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels, F.col("doc_id") < 300)
    wrong = labels.withColumn("toxic", F.when(F.col("doc_id") >= 300, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, wrong, F.col("doc_id") < 300) == model
    found = {r["id"]: r["score"] for r in toxicity.scores(docs, model).collect()}
    assert all((found[i] >= toxicity.LIMIT) == bool(i % 2) for i in range(300, 400))


def test_pairwise_weights_order_the_classes():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, 3))
    y = (x[:, 0] - 0.5 * x[:, 2] > 0).astype(int)
    strength = x @ quality.rank(x, y)
    # The ridge keeps weights finite, so pairs next to the border may be out of order.
    assert (strength[y == 1][:, None] <= strength[y == 0][None, :]).mean() < 0.005


def test_every_labelled_row_counts_for_the_quality_model(spark, docs_of):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choices("ab cd efg hij klmn".split(), k=draw.randint(1, 60)))) for i in range(3000)]
    labels = spark.createDataFrame([(i, int(len(t) > 100) ^ (i % 20 == 0)) for i, t in rows], "doc_id long, quality int")
    found = quality.featured(docs_of(rows))
    model = quality.fit(found, labels, F.lit(True))
    x = np.array([quality.features(t) for _, t in rows])
    y = np.array([r[1] for r in sorted(labels.collect())])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, x.std(0) + 1e-9)
    strength = np.sort(model.strength(x))
    at = int((y == 0).sum())
    assert abs(model.threshold - (strength[at - 1] + strength[at]) / 2) < 1e-8
    # Blocks stand for all pairs: the weights are close to those of all of them.
    every = quality.Model(model.mean, model.scale, quality.rank((x - model.mean) / model.scale, y))
    assert np.corrcoef(every.strength(x), model.strength(x))[0, 1] > 0.98


def test_a_rare_class_has_partners_in_every_block(spark):
    known = spark.range(5000).select("id", (F.col("id") % 1000 == 0).cast("int").alias("y"), F.array(F.col("id").cast("double")).alias("x"))
    dealt = quality.blocks(known.withColumn("n", F.lit(1)), {0: 4995, 1: 5}).select("rows").collect()
    assert all({cell["y"] for cell in r["rows"]} == {0, 1} for r in dealt)
    assert {cell["id"] for r in dealt for cell in r["rows"]} == set(range(5000))


def page(body, ad="", head="<title>t</title>"):
    return (
        f"<html><head>{head}<style>p{{}}</style><script>var a='</p><article>';</script></head><body>"
        f"<nav><ul><li><a href='/a'>Menu one</a><li><a href='/b'>Menu two</a></ul></nav>{ad}{body}"
        "<footer>&copy; all rights</footer></body></html>"
    )


def test_article_of_marked_pages():
    pages = [
        page("<article><h1>Title &amp; more</h1><p><b>Bold<br>line<p>Second&nbsp; para<ul><li>x<li>y</ul></article>"),
        page("<article><h1>Other</h1><p>Text<div class='ad'>Buy</div><form>Name <input></form><p>End&#33;</article>", "<div class='cookie-banner'>Cookies?</div>"),
        page("<article><h1>Third</h1><p>Text <a href='z'>link</a> after<section class='comments'><p>First!</section></article>"),
        None,
        "",
    ]
    assert wrappers.main_texts(pages) == [
        "Title & more\nBold line\nSecond para\nx\ny",
        "Other\nText\nEnd!",
        "Third\nText link after",
        "",
        "",
    ]


def test_article_without_marks_is_found_by_the_wrapper():
    def plain(i):
        words = " ".join(f"w{i}x{k}" for k in range(80))
        links = "".join(f"<li><a href='/{k}'>go {i} {k}</a></li>" for k in range(5))
        return f"<body><div class='top'><a href='/'>home</a></div><div class='x1'><ul>{links}</ul></div><div class='x2'><p>{words}</p><p>more {i}</p></div><div class='sidebar'>see also</div></body>"

    texts = wrappers.main_texts([plain(i) for i in range(5)])
    assert all(t == " ".join(f"w{i}x{k}" for k in range(80)) + f"\nmore {i}" for i, t in enumerate(texts))


def test_wrapper_has_repeats_options_and_slots():
    a = wrappers.wrapper_of(wrappers.parse("<ul><li>a<li>b</ul><p>same</p>"))
    b = wrappers.wrapper_of(wrappers.parse("<ul><li>c</ul><hr><p>same</p>"))
    joined = wrappers.align(a, b)
    by_tag = {c.sign[0]: c for c in joined.children}
    assert by_tag["ul"].children[0].repeated and by_tag["ul"].children[0].children[0].constant is None
    assert by_tag["hr"].pages == 1 and joined.pages == 2
    assert by_tag["p"].children[0].constant == "same"


def test_extraction_of_odd_pages(spark, tables):
    rows = [(1, "http://a.org/", page("<article><p>x</article>")), (2, None, "<p>alone"), (3, "nonsense", None), (None, "http://a.org/q", "< not markup > &lt;"), (5, "http://a.org/", "<div " * 2000), (6, "http://a.org/", page("<article><p>" + "long " * 100_000))]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in QUERIES["op1_html_extraction"](spark, tables(pages=pages)).collect()}
    assert len(got) == len(rows) and got[1]["text"] == "x" and got[2]["text"] == "alone" and got[3]["text"] == "" and got[3]["n_chars"] == 0
    assert got[6]["n_chars"] == 100_000 * 5 - 1


def test_constant_parts_of_the_article_are_the_template():
    draw = random.Random(4)
    words = lambda i: " ".join(f"w{draw.randint(0, 999)}" for _ in range(40)) + f" end{i}"
    bodies = [(words(i), words(i)) for i in range(12)]
    box = "<div class='zq'><p>Support our work</p><ul><li>by card<li>by post</ul></div>"
    own = [f"<article><h1>Title {i}</h1><p>{a}</p>{box if i % 4 else ''}<p>{b}</p><div class='zr'>note {i}</div></article>" for i, (a, b) in enumerate(bodies)]
    assert wrappers.main_texts([page(x) for x in own]) == [f"Title {i}\n{a}\n{b}\nnote {i}" for i, (a, b) in enumerate(bodies)]
    few = wrappers.main_texts([page(x) for x in own[:6]])
    assert "Support our work" in few[1], "too few pages to tell"
    copies = [page("<article><p>one text that all pages have and nothing else</p></article>", f"<p>{i}</p>") for i in range(12)]
    assert set(wrappers.main_texts(copies)) == {"one text that all pages have and nothing else"}


def test_page_numbers_in_ids_and_classes_do_not_part_pages():
    def numbered(i):
        text = " ".join(f"w{i}x{k}" for k in range(60))
        return f"<body class='page page-id-{i}' id='p{i}'><div id='top-{i}'>see all</div><article id='post-{i}' class='post-{i} post'><p>{text}</p><div class='zq'>constant box</div></article></body>"

    own = [numbered(i) for i in range(10, 22)]
    wrapper = None
    for x in own:
        one = wrappers.wrapper_of(wrappers.parse(x))
        wrapper = one if wrapper is None else wrappers.align(wrapper, one)
    assert [c.pages for c in wrapper.children] == [12] and [c.pages for c in wrapper.children[0].children] == [12, 12]
    assert wrappers.main_texts(own) == [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(10, 22)]


@pytest.mark.parametrize("tag", ["div", "span", "section", "ul><li", "article"])
def test_deeply_nested_pages(tag):
    n = 20_000
    ends = "".join(f"</{t}>" for t in reversed(tag.split("><")))
    deep = ["<body>" + f"<{tag}>" * n + f"deep {k}" for k in range(2)] + [f"<{tag}>" * n + "closed" + ends * n + "<p>after"]
    assert wrappers.main_texts([deep[0]]) == ["deep 0"]
    plain = page("<article><h1>Title</h1><p>Text of it</article>")
    texts = wrappers.main_texts([plain, *deep, plain])
    assert texts[0] == texts[-1] == "Title\nText of it"
    assert texts[1:3] == ["deep 0", "deep 1"] and texts[3].startswith("closed")


def test_hot_host_is_split(spark):
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.lit("http://one.org/").alias("url"), F.concat(F.lit("<article><p>t"), F.col("id"), F.lit("</p></article>")).alias("html"))
    found = wrappers.main_text(pages, group=16).collect()
    assert {r["id"]: r["text"] for r in found} == {i: f"t{i}" for i in range(300)}


def slow_rule(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


@pytest.mark.parametrize("ranges", [1, 7])
def test_rules_against_brute_force(spark, ranges):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"), ("allow", "example.org", "/en/12/a"), ("block", "a.example.org", "/en"), ("block", "net", "")]
    draw = random.Random(5)
    urls = [None, "", "no scheme", "http://", "http://ORG", "http://org/", "http://org?x=/", "http://example.org/en/1", "x://A.Example.org/en/12/ab?c#d", "http://notexample.org/es/", "http://a.net#f", "http://b.com/fr/x\ny", "a://b://c/d"]
    for _ in range(300):
        host = ".".join(draw.choices(["a", "example", "www", "b"], k=draw.randint(0, 2)) + [draw.choice(["org", "com", "net", "example.org"])])
        urls.append(f"http://{host}" + draw.choice(["", "/", "/es/", "/en/1", "/en/12/abc", "/fr/", "/de/q", "/fr", "?q", "#/es/"]))
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id long, url string, host string")
    found = url_rules.judge_urls(pages, url_rules.rule_table(spark, rules), ranges=ranges)
    got = {r["row"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()}
    assert got == {i: slow_rule(u, rules) for i, u in enumerate(urls)}
    assert url_rules.judge_urls(pages.where(F.lit(False)), url_rules.rule_table(spark, rules)).count() == 0


def test_urls_in_queries_and_fragments_against_brute_force(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/en/1"), ("block", "com", "/")]
    tails = ["?u=http://x.com/en/1", "#http://x.com/en/1", "?a=b#c://d/en/1", "?u=http://x.com", "/?u=http://x.com/en/1", "/en/1?u=http://x.com/q", "/q/http://x.com/en/1", "://x.com/en/1", "?u=\nhttp://x.com/en/1"]
    urls = [f"{scheme}{host}{tail}" for scheme in ("http://", "://", "x\ny://") for host in ("example.org", "a.Example.org", "é.com", "") for tail in tails]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = url_rules.judge_urls(pages, url_rules.rule_table(spark, rules)).collect()
    assert {r["row"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found} == {i: slow_rule(u, rules) for i, u in enumerate(urls)}


def test_top_k_against_brute_force(spark):
    draw = random.Random(2)
    rows = [(i, [float(draw.choice([0, 1, -1, 0.5]) * draw.random() * (1 + i % 5)) for _ in range(6)]) for i in range(400)]
    rows += [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (420, [0.0] * 6), (440, [3.0] * 6), (460, [3.0] * 6), (None, [1.0] * 6)]
    frame = spark.createDataFrame([(i, v, "z") for i, v in rows], "vec_id long, embedding array<double>, length string")
    got = topk.exact_top_k(frame, F.col("vec_id") % 20 == 0, k=5, bucket=64, query_block=8, seed=16)
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    expected = []
    for q in (i for i in whole if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(whole[q], w, strict=True)), c) for c, w in whole.items() if c != q)[:5]
        expected += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
    few = topk.exact_top_k(frame.where("vec_id in (420, 440, 460)"), F.col("vec_id") % 20 == 0)
    assert few.count() == 6
    assert topk.exact_top_k(frame.where(F.lit(False)), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("power", [22, 26, 42])
def test_top_k_of_large_vectors(spark, power):
    draw = random.Random(power)
    most = {22: 2**22, 26: 2**26 // 20, 42: 2**42}[power]
    # Odd whole numbers far above what doubles hold after multiplication; a sparse set with components of 2 ** 42 against small ones.
    if power == 42:
        rows = [(i, [float(most + 64 * i), 0.0, 0.0] if i % 20 == 1 else [draw.randint(-900, 900) / 64, draw.random(), 1.0]) for i in range(200)]
    else:
        rows = [(i, [(most * 64 - draw.randint(0, 40)) / 64 for _ in range(5)]) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.exact_top_k(frame, F.col("vec_id") % 20 == 0, k=7, bucket=64, query_block=4, seed=16)
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows}
    expected = []
    for q in range(0, 200, 20):
        best = sorted((-sum(a * b for a, b in zip(whole[q], w, strict=True)), c) for c, w in whole.items() if c != q)[:7]
        expected += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


def test_scores_beyond_long_fail(spark):
    for x in (2.0**40, 2.0**60):
        frame = spark.createDataFrame([(20, [x]), (21, [x])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="(?i)long|int"):
            topk.exact_top_k(frame, F.col("vec_id") % 20 == 0).collect()


def planted(n=240):
    draw = random.Random(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    text = lambda k: "\n".join(" ".join(draw.choices(vocabulary, k=30)) for _ in range(k))
    passage = " ".join(draw.choices(vocabulary, k=70))
    rows = [(i, text(3)) for i in range(n)]
    rows += [(i + 1000, rows[i][1].replace("v1 ", "v2 ", 1) + f" extra{i}") for i in range(5)]
    rows += [(i + 2000, text(2) + "\n" + passage) for i in range(4)]
    rows += [(i + 3000, text(2) + " nastyword" * 4) for i in range(60)]
    rows += [(4000, "question number one is asked here in thirteen words or a few more than that")]
    return rows


@pytest.fixture
def planted_folder(spark, docs_of, tables):
    rows = planted()
    labels = spark.createDataFrame([(i, 1, int("nastyword" in t)) for i, t in rows], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "Question number one is asked here in thirteen words or a few more")], "item_id long, text string")
    return tables(documents=docs_of(rows), labels=labels, benchmark=bench), rows


def test_pipeline_catches_what_is_planted(spark, planted_folder):
    folder, rows = planted_folder
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        stages[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {i for i, _ in rows} - set(stages["toxicity"]) == set(range(3000, 3060))
    passage = rows[245][1].rsplit("\n", 1)[1]
    assert sum(passage in t for t in stages["line dedup"].values()) == 1
    assert set(range(240)) <= set(stages["near dedup"])
    # Line dedup takes shared lines from near copies; the stage alone is held against bit distances of its own input.
    near = dict(corpus_pipeline.STAGES)["near dedup"](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    kept = {r["doc_id"] for r in near.collect()}
    marks = [(i, slow_fingerprint(t)) for i, t in rows]
    assert kept == {i for (i, _), first in zip(marks, slow_components(marks, 4), strict=True) if i == first}
    assert set(range(1000, 1005)) - kept
    assert set(stages["near dedup"]) - set(stages["decontamination"]) == {4000}
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {p["doc_id"] for p in pieces} == set(stages["decontamination"])


def test_pipeline_of_nothing(spark, docs_of, tables):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    folder = tables(documents=docs_of([(1, "x")]).where(F.lit(False)), labels=labels, benchmark=bench)
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_stages_take_odd_rows(spark, docs_of, tables):
    rows = [(None, None), (None, "a b c"), (1, ""), (1, "x y"), (1, "x y"), (2, "w " * 50_000)]
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(None, None), (1, "")], "item_id long, text string")
    folder = tables(documents=docs_of(rows), labels=labels, benchmark=bench)
    assert {p["doc_id"] for p in corpus_pipeline.run(spark, folder).collect()} >= {1, 2}


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(importlib.import_module("fieldgap").__file__)
    for folder, _, names in os.walk(root):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert "llm" not in f.read(), name
