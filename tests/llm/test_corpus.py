"""Decontamination, quality rules, page texts, chats and the pipeline."""

from __future__ import annotations

import json
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from ledgerwide.llm import chat, decontaminate, html_text, quality
from ledgerwide.llm.queries import QUERIES, SQL
from ledgerwide.llm.tables import documents, stored
from tests.conftest import FOLDER


def local_score(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (2 if x == y else -1), rows[i - 1][j] - 1, rows[i][j - 1] - 1)
    return max(map(max, rows))


def test_alignment_equals_the_plain_recurrence():
    r = random.Random(2)
    draw = lambda n: np.array([r.randint(1, 4) for _ in range(n)], np.uint64)
    items, windows = [draw(r.randint(4, 20)) for _ in range(80)], [draw(r.randint(4, 40)) for _ in range(80)]
    assert decontaminate.align(items, windows).tolist() == [local_score(a, b) for a, b in zip(items, windows)]


def test_leaks_against_all_alignments(spark):
    r = random.Random(6)
    words = lambda n: [f"v{r.randint(0, 300)}" for _ in range(n)]
    items = [words(r.randint(8, 40)) for _ in range(15)]
    docs = []
    for i in range(60):
        body = words(r.randint(0, 120))
        if i % 3 == 0:
            copy = list(items[i % 15])
            for _ in range(r.randint(0, len(copy) // 4)):
                copy[r.randrange(len(copy))] = "edited"
            body[5:5] = [w.upper() + "," for w in copy]
        docs.append((i, " ".join(body)))
    docs += [(100, None), (101, ""), (3, docs[3][1])]
    bench = [(k, " ".join(w)) for k, w in enumerate(items)] + [(90, None), (91, "too short"), (0, " ".join(items[0]))]
    d = spark.createDataFrame([(*x, 0) for x in docs], "doc_id long, text string, score int")
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in decontaminate.contaminated(spark, d, b).collect())
    plain = lambda t: re.sub("[^a-z0-9]+", " ", (t or "").lower()).split()
    want = []
    for i, text in docs:
        for k, item in enumerate(items):
            score = local_score(item, plain(text)) / (2 * len(item))
            if score >= decontaminate.THRESHOLD:
                want.append((i, k, round(score, 9)))
    assert got == sorted(want) and len(want) > 15
    left = decontaminate.without_leaks(spark, d, b)
    assert left.columns == d.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, _ in docs if i not in {w[0] for w in want})
    none = b.where("item_id < 0")
    assert decontaminate.contaminated(spark, d, none).isEmpty()


def test_regular_edits_and_short_items_against_all_alignments(spark):
    item = lambda k, n: [f"i{k}w{j}" for j in range(n)]
    items = [item(k, n) for k, n in enumerate([40, 40, 30, 24, 9, 8, 7, 6, 5, 4])]
    edits = [
        lambda w, n: [x if (j + 1) % n else "edited" for j, x in enumerate(w)],
        lambda w, n: [y for j, x in enumerate(w) for y in ([x] if (j + 1) % n else [x, "more"])],
        lambda w, n: [y for j, x in enumerate(w) for y in ([x] if (j + 1) % n else [x, "more", "words"])],
        lambda w, n: [x for j, x in enumerate(w) if (j + 1) % n],
    ]
    docs = ["x y " * 20 + " ".join(edit(w, n)) + " z" * 30 for w in items for edit in edits for n in (1, 2, 3, 4, 5)]
    # The commonest pairs of one item stand everywhere.
    docs += [" ".join(items[0][a : a + 12]) for a in (0, 14) for _ in range(40)]
    short = [["lone"], ["two", "words"], ["just", "three", "words"]]
    docs += ["a lone one", "alone", "two words", "two more words", "just three words", "just three", "just the three words", "three words"]
    plain = lambda t: re.sub("[^a-z0-9]+", " ", t.lower()).split()
    want = set()
    for i, text in enumerate(docs):
        for k, w in enumerate(items + short):
            if local_score(w, plain(text)) >= (len(w) if len(w) > 3 else 2 * len(w)):
                want.add((i, k, round(local_score(w, plain(text)) / (2 * len(w)), 9)))
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items + short)], "item_id long, text string")
    got = decontaminate.contaminated(spark, d, b).collect()
    assert {(r.doc_id, r.item_id, round(r.score, 9)) for r in got} == want and len(got) == len(want) > 100


def test_batches_of_alignments_are_bounded_in_words(monkeypatch):
    monkeypatch.setattr(decontaminate, "CELLS", 100)
    windows = [[0, i % 2, 0, 10 + i] for i in range(20)] + [[0, 2, 0, 900]]
    parts = list(decontaminate._batches(windows, np.array([5, 8, 400])))
    assert [w for part in parts for w in part] == windows
    assert all(len(part) == 1 or len(part) * (8 + max(w[3] for w in part)) <= 100 for part in parts)
    assert len(parts[0]) > 1


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


ODD = [None, "", " \n\t", "a a a a a b a a a", "a b", "a\n\na\n a\na\r\n", "é😀 #x y " * 30, "q w e r t " * 20_000]


def test_quality_counts(spark):
    r = random.Random(1)
    texts = ODD + ["".join(r.choice("ab \n#\t") for _ in range(r.randint(0, 200))) for _ in range(60)]
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else "s") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = quality.rated(spark, docs).collect()
    assert len(got) == len(texts)
    for g in got:
        want = plain_counts(texts[g.doc_id])
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want, texts[g.doc_id]
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert g.base_failed == failed and not (failed and g.kept)
    kept = quality.accepted(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(g.doc_id for g in got if g.kept)
    assert quality.rated(spark, docs.limit(0)).isEmpty()


def test_quality_keeps_labelled_good_documents(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    judged = quality.rated(spark, documents(spark, FOLDER)).join(labels, "doc_id").where("not base_failed")
    assert judged.where("quality = 1 and not kept").count() <= 0.02 * judged.where("quality = 1").count()
    assert judged.where("quality = 0 and kept").count() <= 0.1 * max(1, judged.where("quality = 0").count())


PAGE = (
    '<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><a href=/>Home</a></nav>'
    '<div class="cookie-notice">Accept</div><header>Site</header><article><h1>Head&amp;line</h1><p>One <b>two</b><br>three'
    '<p>Four&nbsp;five <a href=x>six</a></p><!-- no --><div class="ad">Buy</div><form>Name</form></article>'
    '<section class="comments"><p>Reader</p></section><aside>Side</aside><footer>Foot</footer></body></html>'
)


def test_page_text(spark):
    rows = [(1, "http://h.example/1", PAGE), (2, "http://h.example/2", PAGE[: PAGE.index("Four") + 4]), (3, None, None)]
    rows += [(4, "bad url", ""), (5, "http://h.example/5", "plain text"), (1, "http://h.example/1", PAGE)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = sorted(((r.page_id, r.text) for r in html_text.extract(spark, pages).collect()))
    whole = "Head&line One two three Four five six"
    assert got[:2] == [(1, whole), (1, whole)] and got[2] == (2, "Head&line One two three Four")
    assert got[3] == (3, "") and got[4] == (4, "")
    assert html_text.extract(spark, pages.limit(0)).isEmpty()


def test_wrapper_without_an_article_element(spark):
    page = "<body><div>Welcome to the site</div><div id=x><p>Text number {0} is this long one.</p><p>More {0}</p></div></body>"
    pages = spark.createDataFrame([(i, f"http://w.example/{i}", page.format(i)) for i in range(8)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(spark, pages).collect()}
    assert got == {i: f"Text number {i} is this long one. More {i}" for i in range(8)}


def test_constant_blocks_inside_an_article(spark):
    page = (
        "<body><article><h1>Title {0}</h1><div><p>Read our weekly letter.</p></div><p>First {0}.</p><p>Support us today.</p>"
        "<p>Second {0}.</p>{1}</article></body>"
    )
    rows = [(i, f"http://a.example/{i}", page.format(i, "<ul><li>x</ul>" * (i % 3 == 0))) for i in range(9)]
    rows += [(100 + k, f"http://copies.example/{k}", page.format("one", "")) for k in range(8)]
    got = {r.page_id: r.text for r in html_text.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {k: t.replace(" x", "") for k, t in got.items() if k < 100} == {i: f"Title {i} First {i}. Second {i}." for i in range(9)}
    whole = "Title one Read our weekly letter. First one. Support us today. Second one."
    assert all(got[k] == whole for k in range(100, 108))  # copies of one page say nothing about a template


def test_tree_matching_is_the_largest():
    a = ["r", ["x", ["p"]], ["y"], ["x"]]
    b = ["r", ["y"], ["x", ["p"], ["q"]], ["x"]]
    assert sorted(html_text.match_trees(a, b)) == [((), ()), ((1,), (2,)), ((1, 1), (2, 1)), ((3,), (3,))]


def test_chat_links_calls_and_results(spark):
    call = {"tool_calls": [{"id": "a", "name": "f", "arguments": {"y": 1, "x": "s"}}, {"id": "b", "name": "g", "arguments": {"k": 2}}]}
    rows = [
        (1, 0, "user", 'hi "q"\n'), (1, 1, "assistant", json.dumps(call)),
        (1, 2, "tool", json.dumps({"tool_call_id": "b", "content": "rb"})),
        (1, 3, "tool", json.dumps({"tool_call_id": "a", "content": "ra"})),
        (1, 4, "tool", json.dumps({"tool_call_id": "zz", "content": "orphan"})),
        (1, 5, "assistant", '{"plain": 1}'), (2, None, None, None), (None, 0, "user", "x"),
    ]
    talks = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, row int")
    schemas = spark.createDataFrame([("f", "x", "string", True), ("f", "y", "string", True), ("g", "k", "integer", True)], chat.SCHEMAS)
    got = {r.conv_id: r for r in chat.format_chats(talks, schemas).collect()}
    assert (got[1].n_messages, got[1].n_calls, got[1].n_linked, got[1].n_orphans, got[1].n_faults) == (6, 2, 2, 1, 1)
    messages = json.loads(got[1].chat)["messages"]
    assert [m["content"] for m in messages] == ['hi "q"\n', "", "ra", "rb", "orphan", '{"plain": 1}']
    assert [c["arguments_valid"] for c in messages[1]["tool_calls"]] == [False, True]
    canonical = lambda x: json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert all(r.chat == canonical(json.loads(r.chat)) for r in got.values())
    assert chat.format_chats(talks.limit(0), schemas).isEmpty()


def test_calls_are_checked_against_what_the_table_shows_of_their_tools(spark, tmp_path):
    def call(turn, name, arguments):
        return (1, turn, "assistant", json.dumps({"tool_calls": [{"id": f"c{turn}", "name": name, "arguments": arguments}]}))

    weather = [{"city": f"v{i}", "days": i} for i in range(9)] + [{"city": 5, "days": 2.5, "unit": "C"}, {"days": 1}]
    talks = [call(i, "weather", a) for i, a in enumerate(weather)] + [call(20, None, {"city": 1}), (2, 0, "user", "x")]
    talks += [call(21, "flag", {"on": True}), call(22, "flag", {"on": "no"}), call(23, "flag", {"on": False})]
    spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    schemas = {tuple(r) for r in chat.used_schemas(spark.read.parquet(f"{tmp_path}/conversations.parquet")).collect()}
    assert schemas == {("weather", "city", "string", True), ("weather", "days", "number", True),
                       ("weather", "unit", "string", False), ("flag", "on", "boolean", True)}
    got = {r.conv_id: r for r in QUERIES["op5_chat"](spark, str(tmp_path)).collect()}
    # The city that is a number, the call without one, and the flag that is a text.
    assert (got[1].n_calls, got[1].n_faults, got[2].n_faults) == (15, 3, 0)
    shown = [m["tool_calls"][0] for m in json.loads(got[1].chat)["messages"]]
    assert {c["id"] for c in shown if not c["arguments_valid"]} == {"c9", "c10", "c22"}


def test_chats_of_the_table_equal_a_plain_version(spark):
    talks = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    want = {}
    for r in sorted(talks.collect(), key=lambda r: (r.conv_id, r.turn)):
        want.setdefault(r.conv_id, []).append({"content": r.text, "role": r.role})
    for r in QUERIES["op5_chat"](spark, FOLDER).collect():
        assert json.loads(r.chat) == {"conv_id": r.conv_id, "messages": want.pop(r.conv_id)}
    assert not want


@pytest.mark.parametrize("extra", [False, True])
def test_pipeline_stages(spark, extra):
    docs = documents(spark, FOLDER).limit(120 if extra else 10**6)
    if extra:
        docs = docs.withColumn("score", docs["doc_id"]).withColumn("kept", docs["lang"])
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        out = stored(spark, stage(spark, docs, FOLDER), name)
        if name != "token_ids":
            assert out.columns == columns
        before, docs = docs.count(), out
        assert 0 < docs.count() <= before
        assert docs.select("doc_id").distinct().count() == docs.count()


def test_chat_copies_null_conversations_and_whole_texts(spark):
    call = json.dumps({"tool_calls": [{"id": "a", "name": "f", "arguments": {}}]})
    result = json.dumps({"tool_call_id": "a", "content": "ra"})
    kept = ['{"temperature":20}', '{"tool_call_id":"z","result":{"k":1}}', '{"tool_call_id":"z","content":"c","more":1}']
    rows = [(1, 0, "assistant", call)] * 2 + [(1, 1, "tool", result)]
    rows += [(None, 0, "assistant", call), (None, 0, "assistant", call), (None, 1, "tool", result), (0, 0, "tool", result)]
    rows += [(2, k, "tool", t) for k, t in enumerate(kept)] + [(2, 9, "assistant", '{"content":"x","answer":5}')]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_chats(talks, chat.no_schemas(spark)).collect()
    by_id = {r.conv_id: r for r in got if r.conv_id is not None}
    assert (by_id[1].n_messages, by_id[1].n_calls, by_id[1].n_linked, by_id[1].n_orphans) == (3, 2, 2, 0)
    messages = json.loads(by_id[1].chat)["messages"]
    assert [len(m.get("tool_calls", [])) for m in messages] == [1, 1, 0] and messages[2]["content"] == "ra"
    assert (by_id[0].n_orphans, by_id[0].n_linked) == (1, 0)
    lone = sorted((r.n_messages, r.n_calls, r.n_linked, r.n_orphans) for r in got if r.conv_id is None)
    assert lone == [(1, 0, 0, 1), (2, 2, 0, 0)]
    assert [m["content"] for m in json.loads(by_id[2].chat)["messages"]] == [*kept, '{"content":"x","answer":5}']


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}
    assert set(SQL) <= set(QUERIES)
