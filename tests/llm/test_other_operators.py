"""Language ID, HTML extraction, chat formatting, secret scans and the pipeline."""

import math
import random
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from topictally.llm import chat, html_extract, language_id, queries, secrets
from topictally.llm.html_blocks import leaf_blocks
from topictally.llm.labelled_pages import labelled_pages

from .conftest import TEXTS

TABLES = Path("/root/testdata/sf0.01")
needs_tables = pytest.mark.skipif(not TABLES.exists(), reason="no test tables")


# Language ID


@pytest.fixture(scope="module")
def labelled(spark):
    pick = random.Random(1)
    sounds = {"xx": "ka ro mi tu ne", "yy": "schl ung eit zwö grü", "zz": "aux oui ção ré ñe"}
    rows = []
    for i in range(240):
        own = pick.choice(sorted(sounds))
        words = ["".join(pick.choices(sounds[own].split(), k=pick.randint(1, 4))) for _ in range(30)]
        rows.append((i, " ".join(words), own))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_language_id_on_held_out_rows(labelled):
    model = language_id.train(labelled.filter("doc_id % 4 <> 2"))
    held_out = labelled.filter("doc_id % 4 = 2")
    got = language_id.predict(held_out, model, extra=(F.col("lang"),)).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_id_of_awkward_rows(awkward, nothing):
    model = language_id.train(awkward)
    got = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.predict(awkward, model).collect()}
    letters = {(i, "en" if any(map(str.isalpha, t or "")) else "und") for i, t in TEXTS}
    assert {(i, lang) for i, lang, _ in got} == letters
    assert all(score == 0 for _, lang, score in got if lang == "und")
    assert language_id.train(nothing) is None
    assert {r["lang_pred"] for r in language_id.predict(awkward, None).collect()} == {"und"}
    assert language_id.predict(nothing, model).collect() == []


def test_fast_look_ups_equal_the_filters(labelled):
    model = language_id.train(labelled)
    rows = language_id.windows_of(b"ka ro mi \xc3\xa9 zw" * 40, model.network.window)
    top, _ = model.pooled(rows)
    model.ready()
    hidden = top.clip(min=0) @ model.out + model.base
    fast = model.log_probabilities(rows)
    assert fast.argmax(axis=1).tolist() == hidden.argmax(axis=1).tolist()


def plain_prediction(model, text):
    """One window after the other, one filter after the other, from the tables as they were trained."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    size = model.network.window
    body = b" " + text.encode().lower()
    body += b" " * (-len(body) % size)
    totals = [0.0] * len(model.labels)
    for start in range(0, len(body), size):
        window, hidden = body[start : start + size], []
        for tables in model.tables:
            for f in range(model.network.filters):
                sums = [
                    sum(float(table[window[at + k], f]) for k, table in enumerate(tables))
                    for at in range(size - len(tables) + 1)
                ]
                hidden.append(max(0.0, max(sums) + float(model.bias[len(hidden)])))
        scores = [
            float(model.base[i]) + sum(h * float(model.out[j, i]) for j, h in enumerate(hidden))
            for i in range(len(totals))
        ]
        norm = max(scores) + math.log(sum(math.exp(s - max(scores)) for s in scores))
        totals = [t + s - norm for t, s in zip(totals, scores)]
    means = [t * size / len(body) for t in totals]
    shares = [math.exp(m - max(means)) for m in means]
    return model.labels[means.index(max(means))], 1 / sum(shares)


def test_language_id_is_what_single_windows_say(spark, labelled):
    model = language_id.train(labelled)
    texts = ["", None, "12 34", "Ka ro mi \u00e9 zw", "abc " * 90, "\u4e2d\u6587 ok"]
    texts += [r["text"] for r in labelled.limit(6).collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in language_id.predict(docs, model).collect():
        label, score = plain_prediction(model, texts[row["doc_id"]])
        assert row["lang_pred"] == label
        assert row["score"] == pytest.approx(score, rel=1e-3)


def test_every_label_is_learned(spark):
    """Also the rarest of very many; the sample of all together stays bounded."""
    rows = [(i, f"word{i % 700} text", f"l{i % 700}") for i in range(1000)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    network = language_id.Network(rows=700, epochs=0)
    sample = language_id.labelled_sample(labelled, network, "text", "lang", "doc_id")
    assert len(sample) == 700
    assert len(language_id.train(labelled, network).labels) == 700


def test_long_texts_are_learned_from_all_over(spark):
    """Texts that share their first thousand bytes differ in what is learned from them."""
    rows = [(i, "same head " * 100 + f"{'xyz' if i % 2 else 'uvw'} " * 3000, f"l{i % 2}") for i in range(40)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    sample = language_id.labelled_sample(labelled, language_id.Network(), "text", "lang", "doc_id")
    own = {"l0": b"uvw", "l1": b"xyz"}
    assert all(any(own[lang] in part for part in parts) for lang, parts in sample)
    assert all([len(p) for p in parts] == [128] * 4 for _, parts in sample)
    model = language_id.train(labelled)
    told = language_id.predict(labelled, model, extra=(F.col("lang"),)).collect()
    assert all(r["lang"] == r["lang_pred"] for r in told)


@needs_tables
def test_language_id_on_the_tables(spark):
    got = queries.op5_language_id(spark, str(TABLES))
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "lang")
    right = got.join(docs, "doc_id").groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert all(r[1] > 0.98 for r in right.collect())


# HTML


@pytest.fixture(scope="module")
def chain():
    return html_extract.train_on_labelled_pages()


def test_blocks_of_untidy_html():
    page = (
        "<!DOCTYPE html><title>no</title><style>p{}</style><body><p>One &amp;amp; <b>two\n\n three"
        "<p>four<br>five</b><div>six<!-- <p>no</p> --> seven</div>tail<script>if (a<b) '</p>'</script>"
        "<ul><li>a<li>b</ul><img alt='>'>&#233;&nbsp;x</i></p>"
    )
    assert [b.text for b in leaf_blocks(page)] == [
        "One &amp; two three", "four five", "six seven", "tail", "a", "b", "é x",
    ]
    assert leaf_blocks("") == []
    assert [b.text for b in leaf_blocks("a < b & c <")] == ["a < b & c <"]
    assert leaf_blocks("<!-- never closed <p>x") == []
    assert len(leaf_blocks("<p>" * 20_000 + "x")) == 1


def test_chain_on_held_out_pages(chain):
    wrong = total = 0
    for page in labelled_pages(100, seed=12345):
        plain, labels = html_extract.labelled_blocks(page)
        wrong += sum(a != b for a, b in zip(labels, chain.viterbi(plain)))
        total += len(labels)
    assert wrong <= 0.015 * total


def test_viterbi_finds_the_best_path():
    pick = random.Random(3)
    for _ in range(50):
        n = pick.randint(1, 7)
        scores = [pick.gauss(0, 1) for _ in range(n)]
        steps = [[pick.gauss(0, 1) for _ in range(2)] for _ in range(2)]
        first = [pick.gauss(0, 1), pick.gauss(0, 1)]

        def value(path):
            total = first[path[0]] + sum(s for s, label in zip(scores, path) if label)
            return total + sum(steps[a][b] for a, b in zip(path, path[1:]))

        paths = [[i >> k & 1 for k in range(n)] for i in range(2**n)]
        assert value(html_extract.best_path(scores, steps, first)) == pytest.approx(max(map(value, paths)))


def test_extract_awkward_pages(spark, chain):
    article = "<nav><a href=x>menu</a></nav><article><h1>T</h1><p>Body text here.</p></article><footer>© x</footer>"
    rows = [(1, "u", article), (1, "u", article), (None, None, None), (2, "v", ""), (3, "w", "<" * 5000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    got = sorted((tuple(r) for r in html_extract.extract(pages, chain).collect()), key=repr)
    assert got[0] == got[1] == (1, "u", "T\nBody text here.")
    assert (None, None, "") in got and (2, "v", "") in got and len(got) == 5
    assert html_extract.extract(pages.limit(0), chain).collect() == []


# Chat


def test_round_trip_of_conflicting_texts():
    formatter = chat.Formatter()
    pick = random.Random(4)
    parts = ["</s>", "<\\/s>", "<\\\\/s>", "[INST]", "[/INST]", "[\\INST] ", "[INST] ", " [/INST]", "ok", "\n", "\\", " "]
    for _ in range(400):
        turns = [
            ("".join(pick.choices(parts, k=pick.randint(0, 2))), "".join(pick.choices(parts, k=pick.randint(0, 6))))
            for _ in range(pick.randint(0, 4))
        ]
        turns = [(pick.choice(["user", "assistant", role]), text) for role, text in turns]
        text, spans = formatter.format(turns)
        assert formatter.parse(text) == turns
        learned = [formatter.unescape(text[a:b]) for a, b in spans]
        assert learned == [t for role, t in turns if role == "assistant"]
    assert formatter.parse("no grammar") is None
    plain = [("user", "a"), ("assistant", "b")]
    assert formatter.format(plain)[0] == "[INST] user [/INST]a</s>[INST] assistant [/INST]b</s>"


def test_chat_of_awkward_rows(spark):
    rows = [
        (1, 2, "assistant", None, 5), (1, 1, "user", "x", 5), (1, None, None, "late", 5),
        (1, 1, "user", "x", 5), (None, 0, "user", "y", 5), (2, 0, "assistant", "z" * 100_000, 5),
    ]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, turns int")
    read = chat.parse_conversations(chat.format_conversations(table)).collect()
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in read}
    assert got == {
        1: [("user", "x"), ("user", "x"), ("assistant", ""), ("", "late")],
        None: [("user", "y")],
        2: [("assistant", "z" * 100_000)],
    }
    assert chat.format_conversations(table.limit(0)).collect() == []


# Secrets


def plain_spans(text, rules):
    found = []
    for place, rule in enumerate(rules):
        pattern = rule.pattern.replace("(?i:", "(?ai:")
        for m in re.finditer(pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), place, rule.name, m.end()))
    return sorted(found)


SECRETS = [
    "token: secret: abcdefghij", "Password='short' passwd = \"longenough1\" é中", "AKIAABC AKIAABCDEFGHIJKLMNO",
    "x" * 70 + "0123456789abcdef" * 3, "API-key=zzzzzzzz api_KEY := 12345678 apikey=\"aaaaaaaa'", "ghp_" + "a" * 40,
    "secret=token=abcdefgh", "-----BEGIN RSA PRIVATE KEY-----", "\U0001f600 token=abcdefgh\U0001f600 token=abcdefgh",
]


def test_scan_equals_plain_search(spark, awkward, tmp_path):
    rows = [(i, t) for i, t in enumerate(SECRETS)] + [(50, SECRETS[0]), (50, SECRETS[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = secrets.scan(docs, str(tmp_path / "a")).collect()
    spans = sorted((r["doc_id"], [tuple(s) for s in r["spans"]]) for r in got)
    assert spans == sorted((i, plain_spans(t, secrets.RULES)) for i, t in rows)
    got = secrets.scan(awkward, str(tmp_path / "b")).collect()
    spans = sorted(((r["doc_id"], [tuple(s) for s in r["spans"]]) for r in got), key=repr)
    assert spans == sorted(((i, plain_spans(t, secrets.RULES)) for i, t in TEXTS), key=repr)


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    schema = "doc_id bigint, text string"
    secrets.scan(spark.createDataFrame([(1, SECRETS[0]), (2, SECRETS[2])], schema), ledger)
    scanned = spark.read.parquet(f"{ledger}/scanned")
    assert scanned.count() == 2 * len(secrets.RULES)
    later = spark.createDataFrame([(3, SECRETS[2]), (4, SECRETS[3])], schema)
    got = secrets.scan(later, ledger).collect()
    assert {r["doc_id"]: len(r["spans"]) for r in got} == {3: 1, 4: 1}
    scanned = spark.read.parquet(f"{ledger}/scanned")
    assert scanned.count() == scanned.distinct().count() == 3 * len(secrets.RULES)
    newer = (secrets.Rule("access", r"AKIA[A-Z0-9]+", version=2),)
    got = secrets.scan(later, ledger, rules=newer).collect()
    assert {r["doc_id"]: len(r["spans"]) for r in got} == {3: 2, 4: 0}


def test_redact(spark, awkward, nothing, tmp_path):
    out = secrets.redact_documents(awkward, str(tmp_path / "l"))
    assert out.columns == awkward.columns
    got = {r["doc_id"]: r for r in out.filter("doc_id = 11").collect()}
    assert got[11]["text"] == "[assign] and password: 'short' é [access]"
    assert got[11]["n_chars"] == len(got[11]["text"])
    assert out.filter("doc_id <> 11 OR doc_id IS NULL").exceptAll(
        awkward.filter("doc_id <> 11 OR doc_id IS NULL")
    ).isEmpty()
    assert out.count() == awkward.count()
    assert secrets.redact_documents(nothing, str(tmp_path / "n")).collect() == []


# Pipeline


def test_pipeline_survives_awkward_rows(spark, awkward, nothing, tmp_path):
    for name, docs in (("awkward", awkward), ("nothing", nothing)):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, "unused")
            if i < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / f"{name}-{i}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}-{i}"))


def test_raw_elements_end_where_they_end():
    def texts(page):
        return [block.text for block in leaf_blocks(page)]

    assert texts("<p>a</p><svg class='i'/><p>b</p><svg><text>x</text></svg><p>c</p>") == ["a", "b", "c"]
    assert texts("<p>a</p><svg/><p>b") == ["a", "b"]
    assert texts("<p>a</p><select-x>b</select-x><title-bar>c</title-bar><p>d</p>") == ["a", "b", "c", "d"]
    assert texts("<p>a</p><script\n>x</script><p>b</p>") == ["a", "b"]


def test_articles_in_plain_containers(chain):
    sentences = [f"This is sentence {i} of an article that goes on for a while." for i in range(4)]
    body = "".join(f"<p>{s}</p>" for s in sentences)
    text = "\n".join(sentences)
    around = "<nav><a href='/'>Home</a> <a href='/b'>Blog</a></nav>{}<footer>© 2024 Somebody</footer>"
    for page in ("{}", "<body>{}</body>", "<div>{}</div>", "<body><div>{}</div></body>", "<div><div><div>{}</div></div></div>"):
        assert html_extract.main_text(page.format(body), chain) == text
        assert html_extract.main_text(around.format(page.format(body)), chain) == text
        assert html_extract.main_text(page.format("<h1>Title</h1>" + body), chain) == "Title\n" + text
    for page in ("<p>{}</p>", "<body><div>{}</div></body>", "{}"):
        assert html_extract.main_text(page.format(sentences[0]), chain) == sentences[0]


@pytest.mark.parametrize(
    "part",
    ["<script ", "<script>", '<a "', "<a b='", "<div>x", "<!--", "<!", "<title></title ", "<span><center>x<p>", "<"],
)
def test_time_grows_with_the_page(chain, part):
    page = part * ((1 << 20) // len(part))
    begun = time.monotonic()
    html_extract.main_text(page, chain)
    # By the square it would be minutes to hours.
    assert time.monotonic() - begun < 20


def test_tags_end_as_in_browsers():
    def texts(page):
        return [block.text for block in leaf_blocks(page)]

    assert texts("<p title=it's>a</p><p>b's</p>") == ["a", "b's"]
    assert texts("<p>a</p><img alt='x > y'><p>b") == ["a", "b"]
    assert texts("<p>a</p><p class='open>b</p>c") == ["a", "b", "c"]
    assert texts("<p>a</p><a href=") == ["a"]
    assert texts("<table><tr><td>a<p>b<td>c<tr><td>d</table>e") == ["a", "b", "c", "d", "e"]
