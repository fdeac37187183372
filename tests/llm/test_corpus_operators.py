"""URL filters, decontamination, language model, Jaccard join, co-training, WARC and the pipeline."""
import base64
import collections
import datetime as dt
import gzip
import hashlib
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from shelfwise.llm import brown_lm, co_training, decontaminate, jaccard_join, url_filters, warc
from tests.llm.conftest import WORDS, sentence

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


# ---- 2 ----

def keys_of(url):
    import re
    m = re.match(url_filters.HOST, url or "")
    if not m:
        return set()
    host, path = m[1].lower(), re.match(url_filters.PATH, url)[1]
    labels, segments = host.split("."), [s for s in path.split("/") if s]
    return ({"host:" + ".".join(labels[i:]) for i in range(len(labels))} | {f"path:{host}/" + "/".join(segments[:i + 1]) for i in range(min(3, len(segments)))}
            | {f"url:{host}/" + "/".join(segments)})


def test_url_filters(spark):
    rng = random.Random(5)
    urls = ["http://a.b.org/x/y/z/w?q=1", "https://u@A.B.org:8080/x/y", "http://b.org", "ftp://other.net/x/", "nonsense", "", None]
    events = [(l, e, k, rng.choice(["add", "remove"]), day(rng.randrange(60))) for l, e in (("l1", "block"), ("l2", "allow"))
              for k in ("host:b.org", "host:org", "path:a.b.org/x/y", "url:a.b.org/x/y/z/w", "path:other.net/x") for _ in range(5 if l == "l1" else 1)]
    captures = [(i, rng.choice(urls), None if i % 17 == 0 else day(rng.randrange(80)), 1) for i in range(200)]
    df = spark.createDataFrame(captures, "capture long, url string, fetched_on date, key int")
    log = spark.createDataFrame([*events, (None, "block", "host:org", "add", DAY)], "list string, effect string, key string, action string, day date")
    got = {r.capture: r for r in url_filters.verdicts(df, url_filters.intervals(log)).collect()}
    assert len(got) == 200 and any(r.blocked for r in got.values()) and not all(r.blocked for r in got.values())
    for i, url, on, _ in captures:
        valid = set()
        for l, e, k in {x[:3] for x in events}:
            past = [(d, a == "add") for ll, ee, kk, a, d in events if (ll, ee, kk) == (l, e, k) and on and d <= on]
            if past and max(past)[1] and k in keys_of(url):
                valid.add((l, e, k))
        block = sorted(k for _, e, k in valid if e == "block")
        allow = [k for _, e, k in valid if e == "allow"]
        assert (got[i].n_block, got[i].n_allow, got[i].first_entry, got[i].blocked) == (
            len(block), len(allow), block[0] if block else None, bool(block) and not allow), (url, on)
    assert url_filters.verdicts(df, url_filters.intervals(log.limit(0))).where("blocked").count() == 0
    assert url_filters.verdicts(df.limit(0), url_filters.intervals(log)).count() == 0


def test_url_filters_deep_paths(spark):
    """Path entries of any depth match, everything below them too."""
    urls = ["http://a.org/1/2/3/4", "http://a.org/1/2/3/4/5/6?q", "http://a.org/1/2/3/x", "http://a.org/1/2", "http://a.org", "http://b.org/1/2/3/4/5/6/7"]
    df = spark.createDataFrame([(i, u, DAY) for i, u in enumerate(urls)], "capture long, url string, fetched_on date")
    log = spark.createDataFrame([("l", "block", k, "add", DAY) for k in ("path:a.org/1/2/3/4", "path:b.org/1/2/3/4/5/6", "path:a.org/1/2/3/4/5/6/7")],
                                "list string, effect string, key string, action string, day date")
    got = {r.capture: r.first_entry for r in url_filters.verdicts(df, url_filters.intervals(log)).collect()}
    assert got == {0: "path:a.org/1/2/3/4", 1: "path:a.org/1/2/3/4", 2: None, 3: None, 4: None, 5: "path:b.org/1/2/3/4/5/6"}


# ---- 3 ----

def test_alignment_matches_the_plain_table():
    rng = random.Random(1)
    for _ in range(40):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(1, 12))] for _ in range(2))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if x == y else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        score, first, past = decontaminate.align([np.array(a, np.uint64)], [np.array(b, np.uint64)])[0]
        assert score == h.max()
        if score:
            assert decontaminate.align([np.array(a, np.uint64)], [np.array(b[first:past], np.uint64)])[0][0] == score


def test_decontaminate(spark, docs, rows):
    rng = random.Random(9)
    items = [(k, sentence(rng, 30)) for k in range(5)] + [(7, None), (8, ""), (9, "lorem ipsum")]
    edited = items[1][1].split(" ")
    edited[10], edited[20] = "unlike", "others"
    planted = [(1001, sentence(rng, 50) + " " + items[0][1].upper() + ". " + sentence(rng, 20)), (1002, " ".join(edited)),
               (1003, sentence(rng, 10) + " " + " ".join(items[2][1].split(" ")[:22])), (1004, items[3][1]), (1004, items[3][1]), (None, items[4][1])]
    more = docs.select("doc_id", "text", "key").union(spark.createDataFrame([(*p, 0) for p in planted], "doc_id long, text string, key long"))
    bench = spark.createDataFrame([(*x, 5) for x in items], "item_id long, text string, key int")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(more, bench).collect()}
    want = {}
    for i, t in rows + planted:
        w = decontaminate.hash_words(decontaminate.plain_words(t), {})
        for k, x in items:
            q = decontaminate.hash_words(decontaminate.plain_words(x), {})
            if len(w) and len(q) >= 3 and (s := int(decontaminate.smith_waterman([q], [w])[0][0])) >= len(q):
                want[i, k] = s
    assert {p: r.score for p, r in got.items()} == want
    assert set(want) == {(1001, 0), (1002, 1), (1003, 2), (1004, 3), (None, 4)}
    assert (got[1001, 0].first_word, got[1001, 0].past_word) == (50, 80)
    assert decontaminate.contaminated(more.limit(0), bench).count() == 0 and decontaminate.contaminated(more, bench.limit(0)).count() == 0


def test_decontaminate_finds_every_edit(spark, monkeypatch):
    """Random replacements, insertions and deletions up to the threshold, held to full alignment alone;
    every item also has a whole copy, so that all its phrases occur."""
    rng = random.Random(12)
    items = [(k, sentence(rng, n)) for k, n in enumerate((30, 31, 12, 7, 3, 60))]
    texts = [sentence(rng, 15) + " " + t + " " + sentence(rng, 15) for _, t in items]

    def put(words):
        texts.append(" ".join([f"x{rng.randrange(999)}" for _ in range(rng.randint(0, 90))] + words + [f"y{rng.randrange(999)}" for _ in range(9)]))
    for _, t in items:
        w = t.split(" ")
        for step in (3, 4, 5, 6):
            put([f"z{i}" if i % step == step - 1 else x for i, x in enumerate(w)])
        put([x for i, y in enumerate(w) for x in (y, f"z{i}")][:-1])
        for _ in range(12):
            share = rng.uniform(0.05, 0.4)
            put([x for i, y in enumerate(w) for x in ([y], [f"z{i}"], [y, f"z{i}"], [])[rng.randint(1, 3) if rng.random() < share else 0]])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t in enumerate(texts):
        w = decontaminate.hash_words(decontaminate.plain_words(t), {})
        for k, x in items:
            q = decontaminate.hash_words(decontaminate.plain_words(x), {})
            if (s := int(decontaminate.smith_waterman([q], [w])[0][0])) >= len(q):
                want[i, k] = s
    assert len(want) > 70
    assert {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(df, bench).collect()} == want
    for name in ("PART_CHARS", "CELLS", "HITS"):
        if hasattr(decontaminate, name):
            monkeypatch.setattr(decontaminate, name, 300)
    assert {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(df, bench).collect()} == want


# ---- 4 ----

def test_brown_model(spark, docs, rows, empty):
    shape = brown_lm.Shape(core=40, endings=16, classes=6, head=20, rounds=4)
    train = docs.where(brown_lm.in_training(F.col("doc_id")))
    model = brown_lm.fit(train, shape=shape)
    got = {r.doc_id: r for r in brown_lm.score(docs, model).collect()}
    texts = {i: (t or "").encode().lower().split() for i, t in rows}
    counts, ends = collections.Counter(), 0
    for i, w in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(w)
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    assert (model.tokens, model.types) == (n, v)
    for i, w in texts.items():
        c = [counts[x] for x in w] + [ends]
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(c), sum(x > 0 for x in c), n)
        assert math.isclose(got[i].base_score, sum(math.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in c), rel_tol=1e-9)
    # the distribution over the next word (all known words, the end, one unseen word a class) adds up to one
    step = 10 ** model.log_step
    assert np.allclose(step.sum(axis=1), 1)
    top = {int(h): k for k, h in enumerate(model.head_hash)}
    mass = np.zeros(shape.classes)
    for x, c in counts.items():
        rank = top.get(brown_lm._hash(x), -1)
        item = rank if 0 <= rank < shape.core else shape.core + brown_lm._ending(x, shape)
        mass[model.item_class[item]] += c + 0.5
    mass[shape.classes - 1] += ends + 0.5
    assert np.allclose((mass + 0.5) / 10 ** model.log_class, 1)
    nothing = brown_lm.fit(empty, shape=shape)
    assert all(r.n_known == 0 and abs(r.base_score) < 1e-9 for r in brown_lm.score(docs, nothing).collect())
    assert brown_lm.score(empty, model).count() == 0


def test_words_after_a_long_text(monkeypatch):
    """A text of more than half of REMEMBERED words leaves room for the words of the texts after it."""
    monkeypatch.setattr(brown_lm, "REMEMBERED", 20)
    table = brown_lm.Words(brown_lm.Shape(core=4, endings=8), np.empty(0, np.int64), np.empty(0, np.int64))
    texts = [[b"a%d" % i for i in range(15)], [b"b%d" % i for i in range(12)], [b"c%d" % i for i in range(8)], [b"d%d" % i for i in range(50)], [b"e%d" % i for i in range(18)]]
    for words in texts:
        at = table.places(words)
        assert table.hash[at].tolist() == [brown_lm._hash(w) for w in words]


def test_exchange_raises_the_likelihood():
    """The gain of a move is the difference of the two likelihoods."""
    rng = np.random.default_rng(0)
    items, size = 8, 4
    n = rng.integers(0, 9, (items, items)).astype(float)
    classes = np.array([0, 1, 2, 0, 1, 2, 0, 3])

    def counts(c):
        m = np.zeros((size, size))
        np.add.at(m, (c[:, None].repeat(items, 1), c[None, :].repeat(items, 0)), n)
        return m

    def likelihood(c):
        m = counts(c)
        return brown_lm._xlogx(m).sum() - 2 * brown_lm._xlogx(m.sum(axis=1)).sum()
    n = n + n.T  # as many in as out, as in running text
    for w in range(items - 1):
        others = np.arange(items) != w
        right = np.bincount(classes[others], n[w, others], size)
        left = np.bincount(classes[others], n[others, w], size)
        best = brown_lm.best_class(counts(classes), int(classes[w]), right, left, n[w, w])
        options = []
        for c in range(size - 1):
            moved = classes.copy()
            moved[w] = c
            options.append(likelihood(moved))
        assert math.isclose(options[best], max(options), rel_tol=1e-9)


# ---- 5 ----

def jaccard_groups(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in sets}


def test_jaccard_join(docs, rows, empty):
    for n, percent in ((4, 85), (2, 60)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_groups(docs, n, percent).collect()}
        assert got == jaccard_groups(rows, n, percent)
    assert jaccard_join.join_groups(empty).count() == 0


def test_jaccard_chains_and_dense_groups(spark):
    """A chain whose ends are far apart, and a group whose members link only through few others,
    also when no pivot round finds the links."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(100)]
    rows, w = [], list(base)
    for i in range(12):
        rows.append((i, " ".join(w)))
        w[7 * i + 3] = f"c{i}"
    for i in range(40):
        w = [f"v{k}" for k in range(250)]
        for _ in range(rng.choice([1, 2, 3])):
            w[rng.randrange(250)] = f"e{rng.randrange(10 ** 6)}"
        rows.append((100 + i, " ".join(w)))
    df = spark.createDataFrame([*rows, (None, rows[0][1])], "doc_id long, text string")
    want = jaccard_groups(rows, 4, 85)
    assert len({c for _, c in want.values()}) < 30
    for rounds in (1, 3):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_groups(df, rounds=rounds).collect()}
        assert got.pop(None)[1] is None and got == want


# ---- 6 ----

def test_co_training(spark):
    rng = random.Random(8)
    data, labels = [], []
    for i in range(240):
        good = i % 4 != 0
        text = sentence(rng, rng.randint(30, 80)) if good else "BUY!! " * rng.randint(20, 60) + "### " * 20
        data.append((i, text, "src1" if good else "src2", None if i % 9 == 0 else "en", 1.0))
        if i % 3 == 0:
            labels.append((i, int(good), 0))
    data.append((None, None, None, None, 0.0))
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string, p double")
    marks = spark.createDataFrame([*labels, (None, 1, 0), (5, None, 0), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    got = co_training.train_and_score(df, marks, co_training.Plan(per_round=20)).collect()
    assert len(got) == 241 and all(0 <= r[c] <= 1 for r in got for c in ("p_text", "p_page", "quality_score"))
    held_out = [r for r in got if r.doc_id is not None and r.doc_id % 3]
    assert np.mean([r.kept == (r.doc_id % 4 != 0) for r in held_out]) > 0.95
    one = co_training.train_and_score(df, marks.where("quality = 1")).collect()
    assert len({r.quality_score for r in one}) == 1 and one[0].kept
    assert co_training.train_and_score(df, marks.limit(0)).first().quality_score == 0.5
    assert co_training.train_and_score(df.limit(0), marks).count() == 0


def test_co_training_reads_words(spark):
    """Metadata and shape say nothing: only the words tell the classes apart. A text with very many
    copies is one pseudo-label."""
    rng = random.Random(9)
    good, bad = [f"g{k:03d}" for k in range(30)], [f"b{k:03d}" for k in range(30)]
    text = lambda y: " ".join(rng.choice(good if y else bad) if rng.random() < 0.4 else f"n{rng.randrange(100):03d}" for _ in range(40))
    data = [(i, text(i % 2), "s", "en") for i in range(300)]
    data += [(1000 + i, data[1][1], "s", "en") for i in range(200)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    got = {r.doc_id: r for r in co_training.train_and_score(df, marks, co_training.Plan(per_round=20)).collect()}
    assert np.mean([got[i].kept == (i % 2 == 1) for i in range(120, 300)]) > 0.9
    assert len({got[i].quality_score for i in range(1000, 1200)}) == 1


# ---- 8 ----

def pages(spark):
    rng = random.Random(6)
    rows = [(i, f"http://h{rng.randrange(5)}.example.org/p{rng.randrange(40)}?q={i % 3}", sentence(rng, rng.randint(0, 50)) + "é\r\n\r\nWARC/1.1\x00") for i in range(120)]
    rows += [(200 + i, rows[i % 7][1], rows[i % 7][2]) for i in range(20)]
    rows += [(300, None, ""), (301, "http://x.org/\r\nEvil: 1", None), (302, "", "plain"), (303, "http://X.org:80/ü ß", "x" * 50_000), (303, "http://X.org:80/ü ß", "x" * 50_000)]
    return rows, spark.createDataFrame([(*r, 1, 1) for r in rows], "page_id long, url string, html string, size int, sha1 int")


def test_members_are_unpacked_in_pieces(monkeypatch):
    """What follows a member in the archive is not copied for each member, and large members are whole."""
    import gzip
    import types
    import zlib
    rng = random.Random(3)
    contents = [bytes(rng.randrange(256) for _ in range(n)) for n in (*[300] * 200, 40_000, warc.PIECE_BYTES, 1)]
    packed = [gzip.compress(c, mtime=0) for c in contents]
    data = b"".join(p + warc.EMPTY_MEMBER for p in packed)
    fed = []

    def counted(bits, make=zlib.decompressobj):
        step = make(bits)

        class Counted:
            eof = property(lambda _: step.eof)
            unused_data = property(lambda _: step.unused_data)

            def decompress(self, piece):
                fed.append(len(piece))
                return step.decompress(piece)
        return Counted()

    monkeypatch.setattr(warc, "zlib", types.SimpleNamespace(decompressobj=counted))
    found = list(warc._members(data))
    assert [c for _, _, c in found] == contents and [n for _, n, _ in found] == [len(p) for p in packed]
    assert all(data[at:at + n] == p for (at, n, _), p in zip(found, packed, strict=True))
    assert sum(fed) <= len(data) + 2 * len(contents) * warc.PIECE_BYTES
    assert list(warc._members(b"")) == [] and [c for _, _, c in warc._members(data[:100])] == [zlib.decompressobj(31).decompress(data[:100])]


def test_warc(spark):
    rows, df = pages(spark)
    path = warc.write_archives(df)
    captures = warc.read_archives(spark, path).cache()
    last = {}
    for i, _, html in rows:
        last[html or ""] = max(last.get(html or "", -1), i)
    want = sorted((i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(),
                   "response" if last[h or ""] == i else "revisit", None if last[h or ""] == i else last[h or ""]) for i, _, h in rows)
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    order = lambda found: sorted((tuple(r[f] for f in fields) for r in found), key=lambda r: r[0])
    assert order(captures.collect()) == want
    index = warc.build_index(captures)
    found = warc.fetch(warc.lookup(index, captures), with_payload=True).collect()
    assert order(found) == want
    html = {i: h or "" for i, _, h in rows}
    assert all(bytes(r.payload).decode() == html[r.page_id] for r in found if r.record_type == "response")
    asked = spark.createDataFrame([(warc.url_key(rows[0][1]),), ("org,nowhere)/",), (None,)], "url_key string")
    assert {r.page_id for r in warc.lookup(index, asked).collect()} == {i for i, u, _ in rows if warc.url_key(u) == warc.url_key(rows[0][1])}
    assert order(warc.read_archives(spark, warc.write_archives(df, min_bytes=10 ** 9)).collect()) == [(*r[:3], "response", None) for r in want]
    none = warc.read_archives(spark, warc.write_archives(df.limit(0)))
    assert none.count() == 0 and warc.fetch(warc.lookup(warc.build_index(none), asked)).count() == 0


def test_archives_are_plain_gzip_members(spark):
    import glob
    path = warc.write_archives(pages(spark)[1]).removeprefix("file://").removeprefix("file:")
    for name in glob.glob(f"{path}/part-*"):
        with gzip.open(name) as f:
            text = f.read()
        assert not text or text.startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_blocks_and_parts_are_searched(spark, monkeypatch):
    rows, df = pages(spark)
    monkeypatch.setattr(warc, "PART_LINES", 30)
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    captures = warc.read_archives(spark, warc.write_archives(df)).cache()
    index = warc.build_index(captures)
    assert index["directory"].select("part").distinct().count() > 2
    for url in {u for _, u, _ in rows}:
        asked = spark.createDataFrame([(warc.url_key(url),)], "url_key string")
        if url in (rows[0][1], rows[3][1], None):
            assert sorted(r.page_id for r in warc.lookup(index, asked).collect()) == sorted(i for i, u, _ in rows if warc.url_key(u) == warc.url_key(url))
    assert warc.lookup(index, captures).count() == len(rows)


def test_url_keys():
    assert warc.url_key("https://User@WWW.Example.org:443/a/b?c#d") == "org,example,www)/a/b?c"
    assert warc.url_key("http://example.org:8080") == "org,example:8080)/"
    assert warc.url_key("example.org?x") == "org,example)/?x" and warc.url_key(None) == ""
    assert len(WORDS) == 60


def test_rare_seeds_lose_nothing():
    """Stretches found by seeds first are those that a plain count of all shared pairs finds."""
    rng = np.random.default_rng(4)
    for words, similar in ((12, 0.5), (40, 0.5), (40, 0.8), (400, 0.35)):
        h = lambda n: rng.integers(1, words + 1, n).astype(np.uint64)  # noqa: B023, E731
        items = [h(n) for n in (3, 4, 9, 20, 20, 45)]
        seeds = decontaminate.Seeds(items, decontaminate.Search(similar=similar))
        for k, x in enumerate(items):  # one more word than may all be missing
            mine = seeds.seed[seeds.item == k]
            assert mine.sum() == len(x) - seeds.need[k] and not mine[-1]
        found = 0
        for n in (0, 1, 2, 5, 60, 300):
            doc = np.concatenate([h(n), items[3][1:], h(n), items[5][::2]]) if n > 2 else h(n)
            held = collections.defaultdict(set)
            pairs = collections.defaultdict(list)
            for i in range(len(doc)):
                for step in (1, 2):
                    if i + step < len(doc):
                        pairs[int(doc[i]), int(doc[i + step])].append(i)  # one apart here, two there: a pair too
            for k, x in enumerate(items):
                for w in range(len(x)):
                    for step in (1, 2):
                        for i in pairs.get((int(x[w]), int(x[w + step])), []) if w + step < len(x) else []:
                            tile = i // int(seeds.span[k])
                            held[k, tile].add(w)
                            if tile:
                                held[k, tile - 1].add(w)
            want = {(k, t * int(seeds.span[k])) for (k, t), v in held.items() if len(v) >= seeds.need[k]}
            got = seeds.candidates(doc)
            assert len(got) == len(set(got)) and set(got) == want
            found += len(want)
        assert found


def test_co_training_keeps_word_classes_small():
    """50,000 labelled rows stay far below the driver's memory: a byte a word class, widened in blocks."""
    import tracemalloc

    import pyarrow as pa
    rng = np.random.default_rng(0)
    n = 3 * co_training.BLOCK + 5
    words = [np.flatnonzero(w).tolist() for w in rng.random((n, co_training.WORDS)) < 0.05]
    rows = pa.table({"text_view": pa.array(rng.normal(size=(n, 9)).tolist()), "words": pa.array(words, pa.list_(pa.int32()))})
    y = (rng.random(n) < 0.4).astype(float)
    plain = np.zeros((n, 10 + co_training.WORDS))
    plain[:, 0], plain[:, 1:10] = 1, rows["text_view"].to_pylist()
    for i, w in enumerate(words):
        plain[i, [10 + k for k in w]] = 1
    tracemalloc.start()
    x = co_training.Examples.of("text_view", rows)
    w = co_training.fit_logistic(x, y, 1.0)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < plain.nbytes * 1.5  # several copies of the matrix before
    penalty = np.r_[1e-6, np.ones(9 + co_training.WORDS)]
    slope = plain.T @ (y - 1 / (1 + np.exp(-(plain @ w)))) - penalty * w
    assert np.abs(slope).max() < 1e-6 and np.allclose(x.scores(w), plain @ w)


def test_grams_of_many_texts_are_made_at_once():
    """pipeline (ngram_jaccard_join), op5_jaccard_join: words of a batch are those of each text by itself, equal words and
    only they have equal hashes, and batches are bounded in rows and bytes."""
    import random

    import pyarrow as pa

    from shelfwise.llm import common
    rng = random.Random(3)
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", "A b\x0bC\x0c\r\nd ", "x" * 300, "no\u00a0break É é ß", "word wordword Wordword", "ab", "c", None, "abcdefgh abcdefghi", "d"]
    texts += [" ".join(rng.choice(["the", "of", "Longer", "wordwordwordword", "é"]) for _ in range(rng.randrange(40))) for _ in range(60)]
    for array in (pa.array(texts), pa.array(["zz", *texts, "zz"]).slice(1, len(texts)), pa.array(texts, pa.large_string())):
        h, ends = common.word_hashes(array)
        own = [h[a:b].tolist() for a, b in zip([0, *ends], ends)]
        words = [common.words_of(t, lower=True) for t in texts]
        assert [len(x) for x in own] == [len(x) for x in words]
        pairs = {(w, x) for ws, xs in zip(words, own) for w, x in zip(ws, xs)}
        assert len(pairs) == len({w for w, _ in pairs}) == len({x for _, x in pairs})
        got, ends = jaccard_join.grams(array, 3)
        for x, a, b in zip(own, [0, *ends], ends):
            n = min(3, len(x))
            assert got[a:b].tolist() == sorted({common.gram_hashes(np.array(x[k:k + n], np.uint64), n)[0] for k in range(len(x) - n + 1)} if n else [])
    big = pa.RecordBatch.from_arrays([pa.array(range(1203)), pa.array([None, "x" * (jaccard_join.BATCH_BYTES + 1), *["y" * 9000] * 601, *["z"] * 600])], names=["doc_id", "text"])
    cut = list(jaccard_join._cut([big]))
    assert pa.Table.from_batches(cut) == pa.Table.from_batches([big])
    assert all(b.num_rows <= jaccard_join.BATCH and (b.num_rows == 1 or b.column(1).nbytes <= jaccard_join.BATCH_BYTES + 9 * b.num_rows) for b in cut)


def test_components_are_joined_by_new_edges(spark):
    """op9_line_dedup: edges added to known components contract their roots only, and a settled forest of stars
    is seen without one more round."""
    import random

    from shelfwise.llm import common
    random.seed(7)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(230)]
    more = [(random.randrange(450), random.randrange(450)) for _ in range(60)]
    frame = lambda rows: spark.createDataFrame(rows, "u long, v long")
    want = {r.node: r.root for r in common.components(frame(edges + more)).collect()}
    known = common.stored(common.components(frame(edges)), "roots")
    got = {r.node: r.root for r in common.joined_components(known, frame(more)).collect()}
    assert got == want
    assert {r.node: r.root for r in common.joined_components(known, frame([])).collect()} == {r.node: r.root for r in known.collect()}
    none = common.components(frame([]))
    assert none.isEmpty() and {r.node: r.root for r in common.joined_components(none, frame([(2, 1)])).collect()} == {1: 1, 2: 1}


def test_settled_components_need_one_round(spark, monkeypatch):
    from shelfwise.llm import common
    rounds = []
    monkeypatch.setattr(common, "stored", lambda df, name, _was=common.stored: rounds.append(name) or _was(df, name))
    out = common.components(spark.createDataFrame([(k, k % 3) for k in range(3, 30)], "u long, v long"))
    assert rounds == ["edges"] and {r.node: r.root for r in out.collect()} == {k: k % 3 for k in range(30)}
