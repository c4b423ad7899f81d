"""Chat formatting, range-coded ids, revisits, phrase index and page text: odd rows, round trips, brute force."""

import hashlib
import random
import zlib
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from iotlake.llm import chat_format, html_region, phrase_index, range_coder, warc_revisit
from iotlake.llm.queries import BYTE_LEVEL, TOKENIZERS

BPE = TOKENIZERS + "/byte_bpe_50k.json"


# Chat formatting

TEXTS = ["</s>[INST] ok [/INST]", "\\", "\\1<[", "<|end|>", "<|turn|>x<|text|>", "", "é 日本 😀", "\\0\\1", "<", "|end|>"]


@pytest.mark.parametrize("text", TEXTS)
def test_escapes_are_reversible_and_leave_no_mark(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(
        chat_format.escaped(F.col("t")).alias("e"), chat_format.unescaped(chat_format.escaped(F.col("t"))).alias("u")).first()
    assert row.u == text and "<" not in row.e and "[" not in row.e


def test_typed_parts(spark):
    part = lambda kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None: (
        kind, text, ref, width, height, seconds, pages)
    rows = [
        (1, 1, "assistant", [part("text", "a<"), part("text", "|end|>b"), part("audio", ref="s3", seconds=1.01)], "x"),
        (1, 0, "user", [part("image", ref="i1", width=28, height=15), part("text", "hi"), part("document", ref="d", pages=3)], "x"),
        (1, 2, None, None, "x"), (1, 2, None, None, "x"), (2, None, "assistant", [], "x"),
        (None, 0, "user", [part("video", "v")], "x"), (None, 0, "user", [part(None, None)], "x"), (3, 0, "user", [part("image", ref="n")], "x"),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_format.PART}>, formatted string")
    found = chat_format.format_chats(turns).select(
        "*", chat_format.read_turns(F.col("formatted")).alias("read"),
        chat_format.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    chats = {r.conv_id: r for r in found if r.conv_id is not None}
    one = chats[1]
    assert [(t.role, t.text) for t in one.read] == [
        ("user", "<|image|>hi<|document|>"), ("assistant", "a<|end|>b<|audio|>"), ("", ""), ("", "")]
    assert one.loss == "a<|end|>b<|audio|>" and one.formatted.count("<|end|>") == 4
    assert [tuple(a) for a in one.attachments] == [("image", "i1", 4), ("document", "d", 1536), ("audio", "s3", 26)]
    assert one.expanded_tokens == 1566
    assert (chats[2].loss, [tuple(t) for t in chats[2].read]) == ("", [("assistant", "")])
    assert [tuple(a) for a in chats[3].attachments] == [("image", "n", 0)]
    assert sorted(t.text for r in found if r.conv_id is None for t in r.read) == ["", "v"]
    assert chat_format.format_chats(turns.where("conv_id > 9")).collect() == []


# Range coder

def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    blocks = [rng.integers(0, 50_257, n) for n in (1, 2, 500, 333)] + [np.zeros(400, np.int64), np.full(300, 65_535), np.zeros(0, np.int64)]
    blocks.append(np.tile(rng.integers(0, 50_257, 20), 30))
    payloads = range_coder.encode_blocks(blocks, 256)
    for lanes in (slice(None), slice(2, 4), slice(7, 8)):
        decoded = range_coder.decode_blocks(payloads[lanes], [len(b) for b in blocks[lanes]], 256)
        assert all((x == y).all() for x, y in zip(decoded, blocks[lanes], strict=True))
    assert len(payloads[4]) < 40 and len(payloads[-1]) < 800


def test_damage_is_noticed():
    ids = np.arange(50)
    block = range_coder.pack(ids, range_coder.encode_blocks([ids], 256)[0], [range_coder.Piece(7, 50, False)], 0, 0, 256)
    assert range_coder.unpack(block)[3] == [range_coder.Piece(7, 50, False)]
    for i in range(len(block)):
        with pytest.raises(ValueError):
            range_coder.unpack(block[:i] + bytes([block[i] ^ 1]) + block[i + 1:])


@pytest.mark.parametrize("a,b", [(b"", b"x"), (b"x", b""), (b"hello ", b"world"), (bytes(300), bytes(range(256)) * 40)])
def test_joined_crc(a, b):
    assert range_coder.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_files_give_every_documents_ids(spark):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    words = ["the", "of", "don't", "  ", "\n", "été", "日本", "<|endoftext|>", "x1", "..."]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "long " * 900), (3, rows[3][1]), (None, "none"), (-4, "neg")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int")
    files = range_coder.write_ids(docs, BPE, 2, BYTE_LEVEL, 3, range_coder.Shape(block=64, lanes=5, slots=256))
    found = sorted(range_coder.read_documents(files).collect(), key=lambda r: r.start)
    plain = Tokenizer.from_file(BPE)
    start = 0
    for r, (i, t) in zip(found, sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")), strict=True):
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_coding_takes_a_few_steps_an_id():
    import time

    rng = np.random.default_rng(3)
    words = [rng.integers(0, 50_257, rng.integers(1, 6)) for _ in range(400)]
    blocks = [np.concatenate([words[int(i)] for i in rng.zipf(1.3, 900) % 400])[:n] for n in rng.integers(900, 1_100, 300)]
    begun = time.process_time()
    payloads = range_coder.encode_blocks(blocks, 2_048)
    decoded = range_coder.decode_blocks(payloads, [len(b) for b in blocks], 2_048)
    taken = time.process_time() - begun
    assert all((x == y).all() for x, y in zip(decoded, blocks, strict=True))
    ids = sum(map(len, blocks))
    assert taken < 10e-6 * ids and sum(map(len, payloads)) < 1.2 * ids


def test_cuts_and_what_is_kept_dont_change_ids(monkeypatch):
    from tokenizers import Tokenizer

    rng = random.Random(4)
    some = [" ", "  ", "\n", " \n", "\n ", "\u00a0", "\u3000", "\u0085", "\x1c", "\x0b", "\u200b", "a", "the", "don't", "'ll", "'", "12", "é", "日本", "😀",
            "<|endoftext|>", "<|endoftext", "...", "\t", "\r\n", "ſ", "\x7f", "\x00", "x" * 80, "²"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(25))) for _ in range(1_500)]
    expected = [e.ids for e in Tokenizer.from_file(BPE).encode_batch(texts, add_special_tokens=False)]
    for memo in (range_coder.MEMO, 50):
        monkeypatch.setattr(range_coder, "MEMO", memo)
        made = range_coder.Tokens(BPE, BYTE_LEVEL)
        assert [f.tolist() for at in range(0, 1_500, 70) for f in made.of(texts[at:at + 70])] == expected
        assert len(made.memo) <= memo + 4_096


def test_wide_ids_are_refused_when_they_are_written():
    import numpy as np

    assert range_coder.encode_blocks([np.array([65535, 0])], 64)
    for ids in ([70_000], [1, -1]):
        with pytest.raises(ValueError):
            range_coder.encode_blocks([np.array([3]), np.array(ids)], 64)


def test_special_tokens_are_read_as_the_library_reads_them():
    from tokenizers import Tokenizer

    from iotlake.llm.queries import BYTE_LEVEL

    plain = Tokenizer.from_file(BPE)
    texts = ["hello <|endoftext|> world", "<|endoftext|><|endoftext|>", "a <|endoftext|", "", "x<|endoftext|>\n y's 12"]
    for pattern in (None, BYTE_LEVEL):
        found = range_coder.Tokens(BPE, pattern).of(texts)
        assert [f.tolist() for f in found] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_empty_file_set(spark):
    files = range_coder.write_ids(spark.createDataFrame([], "doc_id long, text string"), BPE, 2)
    assert files.count() == 0 and range_coder.read_documents(files).collect() == []


# Revisits

@pytest.mark.parametrize("url,expected", [
    ("HTTP://User@Ex.COM:80", "http://ex.com/"), ("https://a.b:443/X?b=2&a=1#f", "https://a.b/X?a=1&b=2"), ("http://a.b:443/", "http://a.b:443/"),
    (" http://a.b/p?", "http://a.b/p"), ("not a url#x", "not a url"), (None, None), ("", "")])
def test_canonical_url(spark, url, expected):
    found = spark.createDataFrame([(url,)], "u string").select(warc_revisit.canonical_url(F.col("u")).alias("k")).first().k
    assert found == expected


def test_revisits_equal_brute_force(spark):
    rng, start = random.Random(3), datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        full = rng.random() < 0.5
        headers = {k: v for k, v in (("ETag", rng.choice(['"a"', 'W/"a"', '"b"', None])), ("last-Modified", rng.choice(["m", "n", None])),
                                     ("Content-Type", "t"), ("Date", str(i))) if v}
        rows.append((i, rng.choice(["http://hot.x/", "HTTP://HOT.x:80", "http://b/"]) if rng.random() < 0.98 else None,
                     start + timedelta(minutes=rng.randrange(400)), "response" if full else "revisit", 200 if full else 304, headers,
                     (None if rng.random() < 0.1 else f"body {i}") if full else None, "clash"))
    rows += [(900, "http://b/", None, "revisit", 304, None, None, "c"), (901, "http://b/", start, "request", 200, {}, "x", "c")]
    rows += [rows[0], rows[1]]
    frame = spark.createDataFrame(rows, "record_id long, url string, date timestamp, kind string, status int, headers map<string,string>,"
                                  "payload string, url_key string")
    key = lambda u: None if u is None else u.lower().replace(":80", "").rstrip("/") + "/"
    tag = lambda h: h.get("ETag", "").removeprefix("W/") or None
    expected = []
    for rid, url, date, kind, _, headers, _, _ in rows:
        if kind != "revisit":
            continue
        before = [r for r in rows if url and date and r[3] == "response" and r[6] is not None and r[2] < date and key(r[1]) == key(url)]
        if not before:
            expected.append((rid, "orphan", None, None))
            continue
        best = max(before, key=lambda r: (r[2], r[0]))
        pairs = [(tag(headers), tag(best[5])), (headers.get("last-Modified"), best[5].get("last-Modified"))]
        state = next(("matched" if a == b else "mismatched" for a, b in pairs if a and b), "unchecked")
        expected.append((rid, state, best[0], best[6] if state == "matched" else None))
    found = warc_revisit.resolve(frame).collect()
    assert sorted(((r.record_id, r.state, r.ref_id, r.payload) for r in found), key=repr) == sorted(expected, key=repr)
    assert {"matched", "mismatched", "unchecked", "orphan"} <= {r.state for r in found}
    merged = next(r for r in found if r.state == "matched")
    assert merged.headers["content-type"] == "t" and merged.headers["date"] == str(merged.record_id)
    assert warc_revisit.resolve(frame.where("record_id < 0")).collect() == []


def test_payload_is_that_of_the_url_instant_and_id(spark):
    at = datetime(2024, 1, 1)
    late = at + timedelta(hours=1)
    rows = [(1, "http://a/x", at, "response", 200, {"etag": "e"}, "of a"), (1, "http://b/y", at, "response", 200, {"etag": "e"}, "of b"),
            (1, "http://b/y", at + timedelta(minutes=1), "response", 200, {"etag": "e"}, "later b"),
            (2, "http://a/x", late, "revisit", 304, {"etag": "e"}, None), (3, "http://b/y", late, "revisit", 304, {"etag": "e"}, None),
            (4, "http://c/", at, "response", 200, {"etag": "f"}, "second"), (4, "http://c/", at, "response", 200, {"etag": "f"}, "first"),
            (4, "http://c/", at, "response", 200, {"etag": "d"}, "another"), (5, "http://c/", late, "revisit", 304, {"etag": "f"}, None)]
    frame = spark.createDataFrame(rows, "record_id long, url string, date timestamp, kind string, status int, headers map<string,string>, payload string")
    found = {r.record_id: (r.state, r.payload) for r in warc_revisit.resolve(frame.repartition(4)).collect()}
    chosen = max("first", "second", key=lambda x: hashlib.md5(x.encode()).hexdigest())
    assert found == {2: ("matched", "of a"), 3: ("matched", "later b"), 5: ("matched", chosen)}


def test_content_headers_of_a_revisit_are_not_merged(spark):
    frame = spark.sql("select map('etag', 'x', 'content-length', '9', 'server', 's') a, map('etag', 'y', 'content-length', '0', 'expires', 'e') b")
    merged = frame.select(warc_revisit.merged_headers(F.col("a"), F.col("b")).alias("m")).first().m
    assert merged == {"etag": "y", "content-length": "9", "server": "s", "expires": "e"}


# Phrase index

def words_of(text):
    word = lambda c: c.isdigit() and c.isascii() or "a" <= c <= "z" or ord(c) > 127
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if word(c) else " " for c in lower).split(" ")


def test_contamination_equals_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(12)] + ["É", "é"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate((3, 10, 11, 25, 1))] + [(20, None), (21, "..."), (1, None), (22, say(30)), (3, "t1 é")]
    docs = [(i, say(rng.randrange(60)) + " " + rng.choice(items)[1].__str__().upper() + ", " + say(5)) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "!!"), (103, docs[0][1]), (0, docs[0][1])]
    windows = {}
    for i, t in items:
        w = [x for x in words_of(t) if x]
        for at in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[at:at + 10]), set()).add(i)
    expected = []
    for i, t in docs:
        w, hit, found = [x for x in words_of(t) if x], set(), set()
        for window, owners in windows.items():
            for at in range(len(w) - len(window) + 1):
                if tuple(w[at:at + len(window)]) == window:
                    hit.update(range(at, at + len(window)))
                    found |= owners
        expected.append((i, len(w), len(hit), sorted(map(str, found))))
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs] + [(None, docs[0][1], "x")], "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    every = phrase_index.contamination(frame, bench)
    alone = every.where("doc_id is null").collect()
    assert [(r.n_words, r.n_hit, r["items"]) for r in alone] == [(len([x for x in words_of(docs[0][1]) if x]), 0, [])]
    found = every.where("doc_id is not null").collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found) == sorted(expected)
    assert any(n for _, _, n, _ in expected)
    for a, b in ((frame.where("doc_id < 0"), bench), (frame, bench.where("item_id < 0"))):
        assert phrase_index.contamination(a, b).where("n_hit > 0").count() == 0


def test_very_long_texts(spark):
    """Whole texts, not their beginnings."""
    passage = " ".join(f"word{i}" for i in range(12))
    docs = spark.createDataFrame([(1, "filler " * 200_000 + passage), (2, "filler " * 10)], "doc_id long, text string")
    bench = spark.createDataFrame([("b", passage)], "item_id string, text string")
    found = {r.doc_id: (r.n_words, r.n_hit) for r in phrase_index.contamination(docs, bench).collect()}
    assert found == {1: (200_012, 12), 2: (10, 0)}
    at = datetime(2024, 1, 1)
    body = "payload " * 200_000
    records = spark.createDataFrame(
        [(1, "http://a/", at, "response", 200, {"etag": "e"}, body), (2, "http://a/", at + timedelta(days=1), "revisit", 304, {"etag": "e"}, None)],
        "record_id long, url string, date timestamp, kind string, status int, headers map<string,string>, payload string")
    assert warc_revisit.resolve(records).select(F.md5("payload")).first()[0] == spark.sql(f"select md5(repeat('payload ', 200000))").first()[0]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i} " + "x" * (50_000 if i == 7 else 0)) for i in range(500)]
    chats = chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select(
        "conv_id", "turn", "role", chat_format.text_parts(F.col("text")).alias("parts")))
    turns = chats.select(chat_format.read_turns(F.col("formatted")).alias("t")).first().t
    assert [(t.role, t.text) for t in turns] == [(r[2], r[3]) for r in rows]


def test_phrases_and_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c x b a"), (2, "a x b x c"), (3, "c b a"), (4, "a b")], "doc_id long, text string")
    phrases = spark.createDataFrame([("p", ["a", "b", "c"]), ("q", ["a"]), ("r", ["a", "b"])], "phrase_id string, terms array<string>")
    postings = phrase_index.build_index(docs, phrases)
    exact = {(r.phrase_id, r.doc_id, r.start) for r in phrase_index.phrase_matches(postings, phrases).collect()}
    assert exact == {("p", 1, 0), ("q", 1, 0), ("q", 1, 5), ("q", 2, 0), ("q", 3, 2), ("q", 4, 0), ("r", 1, 0), ("r", 4, 0)}
    near = {(r.phrase_id, r.doc_id) for r in phrase_index.proximity_matches(postings, phrases, 2).collect()}
    assert near >= {(a, b) for a, b, _ in exact} | {("p", 2)}
    assert ("p", 4) not in near and ("p", 3) not in near


# Page text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if (a<b) "</p>";</script></head><body>
<header><p>site header words here</p></header><nav><ul><li><a href="/">menu one</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><header><h1>Head&amp;line</h1></header><p>First  &lt;b&gt;
 <b>bold</b> words<br>after&nbsp;break.</p><aside>side words</aside><div class="ad">buy this now</div><!-- <p>no</p> -->
<ul><li>item one</li><li>item two</li></ul><form><p>subscribe</p><input></form><p>Last</p>
<section id="comments"><p>a reader comment</p></section></article><footer>&copy; foot words</footer></body></html>"""


def test_page_text(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p>"), (5, "u", "plain  text &amp; more"), (None, "u", "<p>x"),
            (6, "u", "<p>cut <b>off <a href='"), (1, "u", PAGE), (7, "u", "<p>" + "word " * 60_000 + "</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    found = html_region.main_text(frame).collect()
    texts = {r.page_id: r.text for r in found}
    assert len(found) == len(rows)
    assert texts[1] == "Head&line\nFirst <b> bold words\nafter break.\nitem one\nitem two\nLast"
    assert [texts[i] for i in (2, 3, 4, 5, None, 6)] == ["", "", "", "plain text & more", "x", "cut off"]
    assert len(texts[7]) == 299_999
    assert html_region.main_text(frame.where("page_id < 0")).collect() == []


BODY = "<h1>Head</h1><p>" + "some words of the story " * 20 + "</p><p>" + "and more of it " * 20 + "</p>"
STORY = html_region.extract(f"<body><nav>menu</nav><article>{BODY}</article></body>", html_region.DEFAULT)


@pytest.mark.parametrize("page", [
    "<body class='no-sidebar'><nav>menu</nav><article>{}</article></body>",
    "<body><div class='content-with-sidebar'><article>{}</article></div><aside>side</aside></body>",
    "<body><main class='related-topics'>{}</main><footer>end</footer></body>",
    "<body><form action='/'><nav>menu</nav><article>{}</article><input></form></body>",
    "<body><article class='post share-enabled'>{}</article></body>",
    "<body><article data-id='ad'>{}</article></body>",
    "<body><article class='notice'>{}</article></body>",
    "<body><div class='sidebar'><article>{}</article></div></body>",
    "<body><form><div>{}</div></form></body>",
    "<body><article>{}<section class='replies'><p>I say so too</p></section></article></body>",
    "<body><article>{}<ol class='comment-list'><li><article class='comment'>a reader</article></li></ol></article></body>",
    "<body><article>{}</article><div class='thread'><p>" + "a reader says a lot " * 300 + "</p></div></body>",
    "<body><div title='class=ad'><article>{}</article></div></body>",
    "<body><article>{}<p id=cookie-banner>we use them</p><div role='complementary'>more</div></article></body>",
])
def test_a_wrapper_doesnt_empty_a_page_and_comments_go(page):
    assert html_region.extract(page.replace("{}", BODY), html_region.DEFAULT) == STORY and len(STORY) > 700


def test_names_are_learned_from_labelled_pages(spark):
    said = "<div class='xq talk'><p>" + "one reader says this " * 10 + "</p></div>"
    pages = [(i, "u", f"<body><article class='body'>{BODY}</article>{said}</body>") for i in range(5)]
    pages.append((9, "u", f"<body><div class='body'>{BODY}{said}</div></body>"))
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    weights = html_region.fit(frame)
    assert weights.names == {"xq", "talk"}
    assert {r.text for r in html_region.main_text(frame).collect()} == {STORY}
    # The same counts as in one pass over the labelled pages.
    total = sum((html_region.counts(h, weights.names) for i, _, h in pages[:5]), start=html_region.Counter())
    assert html_region.weighed(total).tag == weights.tag and html_region.weighed(total).word == weights.word


def test_a_link_is_a_link_however_deep():
    found = [t for t in html_region.tokens("<p><a>" + "<b>" * 9 + "deep" + "</b>" * 9 + "</a>flat</p>") if t.text]
    assert [t.place for t in found] == ["p/a", "p"]


@pytest.mark.parametrize("piece", ['<a href="x ', "<a ", "<div></p></x>", "<a '>", '<a ">"', "<", "</", "<!-- ", "<script>", "</div ", "<p class=", "<b><i>", "<a b='c' d=\"e\">"])
def test_reading_takes_linear_time(piece):
    import time

    took = []
    for size in (1 << 17, 1 << 20):
        page = "<p>before</p>" + piece * (size // len(piece)) + "<p>after</p>"
        start = time.perf_counter()
        html_region.extract(page, html_region.DEFAULT)
        took.append(time.perf_counter() - start)
    assert took[1] < 24 * max(took[0], 0.02)


def test_region_is_the_best_of_all():
    rng = random.Random(6)
    for _ in range(200):
        weights = html_region.Weights({"p": 1.0, "li": 0.25}, {"p": -0.5, "x": -3.0, "li": -1.0})
        page = [html_region.Token(tag=rng.choice(["p", "x", "li"])) if rng.random() < 0.6 else html_region.Token(
            text="w " * rng.randrange(1, 5), place=rng.choice(["p", "li"])) for _ in range(rng.randrange(14))]
        score = lambda t: weights.of_tag(t.tag) if t.tag else weights.of_word(t.place) * len(t.text.split())
        sums = {(i, j): sum(map(score, page[i:j])) for i in range(len(page)) for j in range(i + 1, len(page) + 1)}
        best = max(sums.values(), default=0)
        start, end = html_region.best_region(page, weights)
        if best <= 0:
            assert start == end
        else:
            assert sums[start, end] == pytest.approx(best)
