"""Quality rules, BPE, substring dedup and line dedup against brute force."""
import collections
import hashlib
import random
import re
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import byte_bpe, line_dedup, quality_rules, substring_dedup
from shelfwise.llm.queries import tokenizer
from tests.llm.conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measure(text):
    text = text or ""
    w = WORD.findall(text)
    windows = collections.Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    hit = {j for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for j in range(k, k + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit), "n_lines": len(lines),
            "n_upper": sum(c.isupper() for c in text), "n_exclamations": text.count("!"),
            "n_stutter_words": sum(a == b for a, b in zip(w, w[1:]))}


def test_quality_ledger(docs, rows, empty):
    got = {r.doc_id: r for r in quality_rules.apply_policy(quality_rules.ledger(docs)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        want = measure(t)
        assert {k: got[i][k] for k in want} == want, t
        bits = got[i].fail_bits
        assert bool(bits & 1) == (want["n_words"] < 20) and bool(bits & 2) == (100 * want["n_repeat_words"] > 30 * want["n_words"])
        assert got[i].kept == (bits == 0)
    assert quality_rules.ledger(empty).count() == 0


def test_policies_and_ablation(docs, empty):
    led = quality_rules.ledger(docs).cache()
    bits = [r.fail_bits for r in led.select("fail_bits").collect()]
    for policy, names in quality_rules.POLICIES.items():
        mask = quality_rules.mask_of(policy)
        out = {r.rule: r for r in quality_rules.ablation(led, policy).collect()}
        assert set(out) == set(names)
        for rule in quality_rules.RULES:
            if rule.name in out:
                r, b = out[rule.name], 1 << rule.bit
                assert (r.n_docs, r.n_failed) == (len(bits), sum(bool(x & b) for x in bits))
                assert r.n_failed_only_here == sum(x & mask == b for x in bits)
                assert r.n_kept_without_rule == sum(not x & mask & ~b for x in bits)
    assert all(r.n_docs == 0 for r in quality_rules.ablation(quality_rules.ledger(empty)).collect())


def test_native_plans(docs):
    for df in (quality_rules.ledger(docs), line_dedup.lines(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_byte_bpe_is_exact(docs, rows, empty):
    import tiktoken
    path, pattern = tokenizer()
    ranks = byte_bpe.load_ranks(path)
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in byte_bpe.round_trip(docs, path, pattern).collect()}
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        assert bytes(got[i].ids) == struct.pack(f"<{len(ids)}I", *ids) and bytes(got[i].decoded) == (t or "").encode()
    one = byte_bpe.decode(byte_bpe.encode(docs, path, pattern), path, pattern)
    assert {r.doc_id: bytes(r.decoded) for r in one.collect()} == {i: (t or "").encode() for i, t in rows}
    assert byte_bpe.round_trip(empty, path, pattern).count() == 0


def test_byte_bpe_pairs_and_white_space():
    import random
    import tiktoken
    path, pattern = tokenizer()
    ranks = byte_bpe.load_ranks(path)
    codec = byte_bpe.Codec(ranks, pattern)
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    for _ in range(3000):
        s = "".join(rng.choice("ab1 \n\t.'s!é　\x1c\x85 thert") for _ in range(rng.randint(0, 20)))
        assert np.frombuffer(codec.encode(s), "<u4").tolist() == enc.encode_ordinary(s), s
    ids = list(ranks.values())
    for _ in range(3000):
        a, b = rng.choice(ids), rng.choice(ids[:3000])
        parts = [codec.tokens[a][k:k + 1] for k in range(len(codec.tokens[a]))] + [codec.tokens[b][k:k + 1] for k in range(len(codec.tokens[b]))]
        while True:
            options = [(ranks[parts[k] + parts[k + 1]], k) for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in ranks]
            if not options:
                break
            k = min(options)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        assert codec.pair_fits(a, b) == (parts == [codec.tokens[a], codec.tokens[b]])


def removed_words(rows, length):
    first, out = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode().split()
        hit, own = set(), []
        for k in range(len(w) - length + 1):
            x = tuple(w[k:k + length])
            hit.update(range(k, k + length)) if x in first else own.append(x)
        first.update(dict.fromkeys(own, i))
        out[i] = (len(w), len(hit), b" ".join(x for k, x in enumerate(w) if k not in hit))
    return out


@pytest.mark.parametrize("length,seed", [(50, 16), (12, 5), (6, 6)])
def test_substring_dedup(docs, rows, length, seed):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept.encode()) for r in substring_dedup.dedup(docs, length, seed).collect()}
    assert got == removed_words(rows, length)


def test_substring_dedup_edges(spark, empty):
    assert substring_dedup.dedup(empty).count() == 0
    long = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(None, long), (5, long), (5, long), (9, long + " tail"), (9, None)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_removed) for r in substring_dedup.dedup(df).collect())
    assert got == [(-1, 0), (5, 0), (5, 0), (9, 0), (9, 80)]


def test_substring_dedup_hot_anchor(spark, monkeypatch):
    """A footer shorter than a window, in every document, between words of their own: its different
    windows do not meet in one group, and the windows that do repeat are found."""
    import random
    rng = random.Random(3)
    own = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    footer = " ".join(f"f{i}" for i in range(20))
    rows = [(i, f"{own(60)} {footer} {own(60)}") for i in range(60)]
    rows += [(100 + i, own(5) + " " + rows[i][1]) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = removed_words(rows, 50)
    assert sum(n > 0 for _, n, _ in want.values()) == 10
    for hot in (8, 1000):
        monkeypatch.setattr(substring_dedup, "HOT", hot, raising=False)
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept.encode()) for r in substring_dedup.dedup(df).collect()} == want
    monkeypatch.setattr(substring_dedup, "HOT", 8)
    met = substring_dedup.windows_met(df).where("meet is not null").groupBy("meet").count()
    assert met.agg(F.max("count")).first()[0] <= 8


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def normal(line):
    return " ".join("".join(c if c.isalnum() else " " for c in line.lower()).split())


def alike(a, b):
    """The rule itself: equal normal forms, or an edit similarity of 0.8 over characters (words in long lines)."""
    if a == b:
        return True
    x, y = a.split(" "), b.split(" ")
    if min(len(set(x)), len(set(y))) < 3:
        return False
    if max(len(a), len(b)) <= line_dedup.EDIT_CHARS:
        x, y = a, b
    most = int(max(len(x), len(y)) * 0.2 + 1e-9)
    return abs(len(x) - len(y)) <= most and edit_distance(x, y) <= most


def line_groups(rows):
    """First occurrence of every line's group: {(doc_id, line): (doc_id, line)}."""
    norm = {(i, k): normal(x) for i, t in rows if t is not None for k, x in enumerate(t.split("\n")) if normal(x)}
    root = {p: p for p in norm}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p
    places = sorted(norm)
    for i, a in enumerate(places):
        for b in places[i + 1:]:
            if top(a) != top(b) and alike(norm[a], norm[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {p: top(p) for p in places}


def test_lines_are_measured_once(docs):
    """What is measured of a whole line is computed below the explode of its words, and the words are made once."""
    plan = line_dedup.lines(docs)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate explode", 1)
    assert "replace(" not in above and "replace(" in below
    assert plan.count("array_distinct") == 1


def test_only_what_differs_is_compared(spark):
    """Shared words at the ends of two lines are left out of the comparison, which stays exact."""
    rng = random.Random(8)
    pairs = [("a b c", "a b c"), ("a", "a a"), ("a b", "b"), ("a b a", "a"), ("x a", "y a"), ("aa bb", "bb aa"), ("a b c d", "a d"), ("abcd", "abcde")]
    for _ in range(400):
        words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 14))]
        other = list(words)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(other))
            other[at:at + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0 if len(other) > 1 else 1, 2)
        pairs.append((" ".join(words), " ".join(other)) if other else ("a", "a"))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, na string, nb string")
    between = line_dedup._between(F.col("na"), F.col("nb"))
    got = {r.i: r for r in df.select("i", line_dedup._similar("na", "nb").alias("same"), between.alias("w")).collect()}
    for i, (a, b) in enumerate(pairs):
        assert got[i].same == (edit_distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)), (a, b)
        u, v = got[i].w
        assert not (u and v) or (u[0] != v[0] and u[-1] != v[-1]), (a, b, u, v)
    assert [tuple(map(list, got[i].w)) for i in (0, 6)] == [([], []), (["b", "c"], [])]


def test_line_fingerprints_need_no_shuffle_and_keys_are_compiled(spark):
    """op9_line_dedup: a line's fingerprint is made where it is read, and no method of the keys' code is too long
    (8,000 bytes) for Java to compile."""
    found = line_dedup.lines(spark.createDataFrame([(1, "some words in a line")], "doc_id long, text string"))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    code = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    parts = code.codegenStringSeq(line_dedup.keys(found)._jdf.queryExecution().executedPlan())
    assert parts.size() and max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())) < 8000


def test_walk_bounds_the_distance(spark):
    """Walking the words of one line along another's gives an upper bound, exact for words put in or left out;
    pairs that are not likely alike are judged in the same way."""
    rng = random.Random(12)
    pairs = [("a b c d e", "a b d e"), ("a b c d", "a x b c d"), ("a b c d e f", "a c d x e f"), ("a", "b c d e f g"), ("a b a b", "b a b a")]
    for _ in range(300):
        words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 30))]
        other = list(words)
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(other))
            other[at:at + rng.randint(0, 2)] = [rng.choice(words)] * rng.randint(0 if len(other) > 2 else 1, 2)
        pairs.append((" ".join(words), " ".join(other) or "a"))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, na string, nb string")
    words = F.struct(F.split("na", " ").alias("u"), F.split("nb", " ").alias("v"))
    rows = df.select("i", line_dedup._walked(words).alias("most"), line_dedup._similar("na", "nb", False).alias("same"), line_dedup._similar("na", "nb").alias("likely"))
    got = {r.i: r for r in rows.collect()}
    for i, (a, b) in enumerate(pairs):
        d = edit_distance(a, b)
        assert got[i].most >= d and got[i].same == got[i].likely == (d <= int(max(len(a), len(b)) * 0.2 + 1e-9)), (a, b)
    assert [got[i].most for i in range(3)] == [2, 2, 4]


def test_line_dedup(docs, rows, empty):
    first = line_groups(rows)
    gone = {p for p, f in first.items() if f != p}
    assert len(gone) > 8
    got = {r.doc_id: r for r in line_dedup.report(docs).collect()}
    texts = {r.doc_id: r for r in line_dedup.dedup(docs).collect()}
    for i, t in rows:
        lines = [] if t is None else t.split("\n")
        out = [k for k in range(len(lines)) if (i, k) in gone]
        assert (got[i].n_lines, got[i].n_removed, list(got[i].removed)) == (len(lines), len(out), out)
        assert texts[i].text == (None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in out))
        assert texts[i].n_words == 10  # the caller's own column
    left = {r.doc_id for r in line_dedup.dedup(docs, drop_emptied=True).collect()}
    assert left == {i for i, t in rows if t is None or any((i, k) not in gone for k in range(t.count("\n") + 1))}
    assert line_dedup.report(empty).count() == 0 and line_dedup.dedup(empty).columns == empty.columns


def test_line_dedup_keeps_callers_columns(spark):
    clash = ("_key", "_id", "_tag", "_removed", "_kept", "n_lines_left", "doc", "removed", "every", "steps", "left", "_word", "_bit", "_bitmap", "h", "norm")
    df = spark.createDataFrame([(1, "a b c d", *range(len(clash))), (2, "A b, c d!\nown line", *range(len(clash))), (None, "x", *range(len(clash))), (3, None, *range(len(clash)))],
                               ["doc_id", "text", *clash])
    out = line_dedup.dedup(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert {i: r.text for i, r in got.items()} == {1: "a b c d", 2: "own line", None: "x", 3: None}
    assert all(tuple(r)[2:] == tuple(range(len(clash))) for r in got.values())


def test_line_dedup_recall_and_precision(spark):
    """Truth is the edit similarity alone: found by no fingerprint of the operator's own."""
    import random
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    rows, planted = [], {}
    for n in (6, 10, 20, 50, 100):
        for _ in range(60):
            a = [rng.choice(words) for _ in range(n)]
            b = list(a)
            b[rng.randrange(n)] = rng.choice(words)
            if alike(" ".join(a), " ".join(b)):
                planted.setdefault(n, []).append(len(rows) + 1)
            rows += [(len(rows), " ".join(a)), (len(rows) + 1, " ".join(b))]
    got = {r.doc_id for r in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    for n, pairs in planted.items():
        assert len(pairs) > 40 and sum(i in got for i in pairs) >= 0.9 * len(pairs), n
    assert got <= {i for pairs in planted.values() for i in pairs}


def test_line_dedup_leaves_unrelated_lines(spark):
    """Texts over one small vocabulary are not copies of each other, whatever their lengths."""
    import random
    rng = random.Random(8)
    rows = [(i, sentence(rng, n)) for i, n in enumerate((3000, 2500, 400, 60, 3000, 700, 20, 6))]
    w = rows[0][1].split(" ")
    for k in range(0, 3000, 600):
        w[k] = "changed"
    rows.append((99, " ".join(w)))  # a long line with few edits is found
    got = {r.doc_id for r in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {99}


def test_line_dedup_odd_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    got = lambda rows: sorted((r.doc_id if r.doc_id is not None else -1, list(r.removed)) for r in line_dedup.report(make(rows)).collect())
    # repeated rows are one document; null ids come first; blank and symbol lines stay
    assert got([(5, "one\n\n--\ntwo"), (5, "one\n\n--\ntwo"), (None, "One!"), (7, "\n--\n"), (8, None)]) == [(-1, []), (5, [0]), (5, [0]), (7, []), (8, [])]
    many = [(1, "same words in this line")] * 300 + [(2, "same words in this line\nsame words in that line")]
    assert got(many) == [(1, [])] * 300 + [(2, [0, 1])]  # the votes of repeated rows do not run over
    assert got([(1, "a b\na c\na b")]) == [(1, [2])]  # too short for anything but equality


def test_line_dedup_dense_group(spark):
    """Many edited copies of one line are one group, whatever centres and keys they fall in."""
    import random
    rng = random.Random(2)
    base = [f"word{i}" for i in range(60)]
    lines = []
    for _ in range(120):
        w = list(base)
        w[rng.randrange(60)] = f"other{rng.randrange(10 ** 6)}"
        lines.append(" ".join(w))
    df = spark.createDataFrame([(i, t) for i, t in enumerate([" ".join(base), *lines])], "doc_id long, text string")
    assert {r.doc_id for r in line_dedup.removed_lines(df).collect()} == set(range(1, 121))


def test_long_lines_are_bounded_by_words(spark):
    """Above EDIT_CHARS words are compared: lines of like words and unlike lengths meet, lines over the
    same vocabulary with far fewer or other words do not."""
    rng = random.Random(31)
    words = [f"w{i}" for i in range(40)]
    line = [rng.choice(words) for _ in range(900)]
    longer = ["x" * 120 if i % 50 == 7 else w for i, w in enumerate(line)]  # 2 % of the words, over half as many characters again
    other, short = [rng.choice(words) for _ in range(900)], [rng.choice(words) for _ in range(300)]
    texts = [" ".join(x) for x in (line, longer, other, short, line + ["end"])]
    assert line_dedup.EDIT_CHARS < len(texts[0]) < 0.8 * len(texts[1])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.n_removed for r in line_dedup.report(df).collect()}
    assert rows == {0: 0, 1: 1, 2: 0, 3: 0, 4: 1}
    near = line_dedup.lines(df).select("doc_id", F.struct("simhash", "size", "k").alias("a"))
    pair = near.where("doc_id = 0").select("a").crossJoin(near.where("doc_id > 0").select("doc_id", F.col("a").alias("b")))  # four rows
    allowed = {r.doc_id for r in pair.withColumn("b", F.expr("named_struct('simhash', a.simhash, 'size', b.size, 'k', b.k)")).where(line_dedup._near("a", "b")).collect()}
    assert allowed == {1, 2, 4}
