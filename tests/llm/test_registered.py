"""Every registered corpus query, and the pipeline, over small written tables against
brute force: whole rows and values."""

import collections
import hashlib
import random
import re
import struct
import zlib

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from silverthread.llm import licenses
from silverthread.llm.queries import BPE_RANKS, QUERIES, WORD_BPE

from test_operators import classes_of, plain_spans

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BLANK = " \t\n\x0b\x0c\r"


def prose(r, n):
    return [r.choice(WORDS) for _ in range(n)]


WORDS = ["".join(random.Random(k).choice("abcdefghijklmnoprst") for _ in range(2 + k % 7)) for k in range(400)]
ITEMS = [(k, " ".join(prose(random.Random(900 + k), 30)).capitalize() + ". " + " ".join(prose(random.Random(950 + k), 6)) + ".") for k in range(6)]


@pytest.fixture(scope="module")
def documents():
    """Prose with copies, near copies, boilerplate, leaks, junk, identifiers and licenses."""
    r, rows = random.Random(3), []
    for _ in range(70):
        body = prose(r, r.randint(25, 90))
        for k in range(9, len(body), 10):
            body[k] += "."
        rows.append(" ".join(body))
    rows += [rows[0], rows[1], rows[1]]
    for k in (2, 3, 4):
        words = rows[k].split(" ")
        words[len(words) // 2] = "changed"
        rows.append(" ".join(words))
    rows += [rows[k] + "\nShare this page \nShare this page" for k in range(20, 32)]
    rows += [f"{rows[40 + k]}\n{ITEMS[k][1]}\n{rows[50 + k]}" for k in range(4)]
    rows += ["buy buy buy now " * 40, "# $ % " * 30, "x", "", None, "\n \n", "é" * 3000 + " " + "word " * 300]
    rows += ["mail to a.b@mail.example.com or +1 (222) 555-0101 from 1.2.3.4 by 4111 1111 1111 1111 today " + rows[9]]
    rows += ['token = "' + "0123456789abcdef" * 2 + "abcdefab" + '" ' + rows[10], licenses.FULL[0][1], "text\n\n" + licenses.FULL[1][1]]
    return [(k, t, "en" if k % 2 else "de", f"src{k % 3}", len(t or "")) for k, t in enumerate(rows)]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory, documents):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(documents, SCHEMA).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(k, int(k % 9 != 0), int(k % 11 == 0)) for k in range(0, len(documents), 2)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def byte_bpe():
    import base64

    with open(BPE_RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def result(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = {r.doc_id: r for r in df.collect()}
    assert len(rows) == df.count()
    return rows


def test_op1(spark, sf_dir, documents):
    got = result(spark, sf_dir, "op1_pii")
    assert len(got) == len(documents)
    for doc, text, *_ in documents:
        spans = plain_spans(text)
        row = got[doc]
        assert row.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        kinds = collections.Counter(s.split(":")[0] for s in spans.split(",") if s)
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(kinds[k] for k in ("email", "ip", "card", "phone"))
        assert set(filter(None, spans.split(","))) <= set(row.spans.split(","))
    secret = next(d for d, t, *_ in documents if t and t.startswith("token"))
    assert got[secret].spans == "secret:9:49" and got[secret].n_secret == got[secret].n_added == 1


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def without_frequent(rows):
    seen = collections.Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    return {d: [x for x in (t or "").split("\n") if seen[key(x)] < 10] for d, t in rows}


def test_op2(spark, sf_dir, documents):
    got = result(spark, sf_dir, "op2_line_dedup")
    kept = without_frequent([(d, t) for d, t, *_ in documents])
    for doc, text, *_ in documents:
        row, lines = got[doc], (text or "").split("\n")
        assert (row.n_lines, row.n_dropped) == (len(lines), len(lines) - len(kept[doc]))
        assert row.kept_sha256 == hashlib.sha256("\n".join(kept[doc]).encode()).hexdigest()
    assert sum(r.n_dropped for r in got.values()) == 24


def test_op3(spark, sf_dir, documents, byte_bpe):
    got = result(spark, sf_dir, "op3_byte_bpe")
    for doc, text, *_ in documents:
        ids = byte_bpe(text or "")
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_op4(spark, sf_dir, documents):
    got = result(spark, sf_dir, "op4_license_scan")
    whole, inside = len(documents) - 2, len(documents) - 1
    assert (got[whole].license, got[whole].licenses, got[whole].full) == ("MIT", "MIT", "MIT")
    assert (got[inside].license, got[inside].licenses, got[inside].full) == (None, "MIT", "MIT")
    assert all((r.license, r.licenses, r.full) == (None, "", "") for d, r in got.items() if d < whole)


def leaks_of(rows):
    """Documents that hold an item word for word, as the planted ones do."""
    words = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    return {(d, i) for d, t in rows for i, item in ITEMS if f" {words(item)} " in f" {words(t)} "}


def test_op5(spark, sf_dir, documents):
    df = QUERIES["op5_decontamination"](spark, sf_dir)
    found = [(r.doc_id, r.item_id) for r in df.collect()]
    assert sorted(found) == sorted(leaks_of([(d, t) for d, t, *_ in documents])) and len(found) == 4


def test_op6(spark, sf_dir, documents, byte_bpe):
    got = result(spark, sf_dir, "op6_token_counts")
    for doc, text, lang, source, _ in documents:
        text = text or ""
        n, half = len(text), len(text) // 2
        cut = min(half + 40, n)
        last = max(n - 20, half + 40)
        edited = text[: n // 4] + f" {source}: " + text[n // 4 : half] + text[cut : min(last, n)] + f"\n[{lang}]"
        assert (got[doc].n_tokens, got[doc].n_tokens_edited) == (len(byte_bpe(text)), len(byte_bpe(edited))), doc
    long = max(documents, key=lambda d: len(d[1] or ""))[0]
    assert got[long].n_reencoded <= got[long].n_pretokens + 20


def test_op7(spark, sf_dir, documents):
    got = result(spark, sf_dir, "op7_near_dedup")
    assert {d: r.class_id for d, r in got.items()} == classes_of([(d, t) for d, t, *_ in documents])


def test_op8(spark, sf_dir, documents):
    got = result(spark, sf_dir, "op8_toxicity")
    assert len(got) == len(documents)
    for doc, row in got.items():
        assert row.held_out == (zlib.crc32(str(doc).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.7)


def test_op9(spark, sf_dir, documents):
    got, start = result(spark, sf_dir, "op9_token_files"), 0
    library = Tokenizer.from_file(WORD_BPE)
    for doc, text, *_ in documents:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def quality_of(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    windows = collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    repeated = {j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
    lines, seen, copies = (text or "").split("\n"), set(), 0
    for line in lines:
        if line.strip(BLANK):
            copies += line in seen
            seen.add(line)
    symbols = sum(w.count(c) for w in words for c in "#*$%&|<>")
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, copies, len(repeated), failed


def test_op10(spark, sf_dir, documents):
    got = result(spark, sf_dir, "op10_quality_rules")
    for doc, text, *_ in documents:
        row = got[doc]
        found = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)
        assert found == quality_of(text), doc
        assert not (row.base_failed and row.kept)
    assert 50 < sum(r.kept for r in got.values()) < len(documents)


def test_pipeline(spark, sf_dir, documents, byte_bpe):
    verdict = result(spark, sf_dir, "op10_quality_rules")
    rows = [(d, t) for d, t, *_ in documents if verdict[d].kept]
    rows = [(d, "\n".join(without_frequent(rows)[d])) for d, _ in rows]
    classes = classes_of(rows)
    rows = [(d, t) for d, t in rows if classes[d] == d]
    leaked = {d for d, _ in leaks_of(rows)}
    rows = {d: t for d, t in rows if d not in leaked}
    assert leaked and len(rows) < len(classes)
    df = corpus_pipeline.run(spark, sf_dir)
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "n_tokens", "round_trip"]
    got = {r.doc_id: r for r in df.collect()}
    assert df.count() == len(got) and {d: r.text for d, r in got.items()} == rows
    known = {d: rest for d, _, *rest in documents}
    for doc, row in got.items():
        ids = byte_bpe(rows[doc])
        assert bytes(row.ids) == struct.pack(f"<{len(ids)}I", *ids) and row.n_tokens == len(ids) and row.round_trip
        assert [row.lang, row.source, row.n_chars] == known[doc]


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_rows(spark, sf_dir, documents, stage):
    """Null ids, repeated rows, ties and columns of names that stages use inside."""
    extra = "doc_id bigint, text string, __doc string, ids string, verdict int, first_id int, leaked int"
    text = documents[5][1]
    rows = [(1, text, "a", "b", 1, 2, 3), (1, text, "a", "b", 1, 2, 3), (None, text + " more of it", "c", None, 4, 5, 6),
            (None, None, "d", "e", None, None, None), (2, "", "f", "g", 7, 8, 9), (1, documents[6][1], "h", "i", 0, 0, 0)]
    name, function = corpus_pipeline.STAGES[stage]
    out = function(spark, spark.createDataFrame(rows, extra), sf_dir)
    kept = sorted(map(repr, (tuple(r)[:7] for r in out.collect())))
    if name in ("line dedup", "decontamination", "byte-level BPE"):
        texts = [(d, t if name != "line dedup" else t or "", *rest) for d, t, *rest in rows]
        assert kept == sorted(map(repr, texts))
    elif name == "near dedup":
        # Of a repeated row one stays; texts that are alike are one class, as are those without words.
        assert len(kept) == 3
    else:
        assert all(x in list(map(repr, rows)) for x in kept)
    assert out.columns[:3] == ["doc_id", "text", "__doc"]
    empty = function(spark, spark.createDataFrame([], extra), sf_dir)
    assert empty.count() == 0
