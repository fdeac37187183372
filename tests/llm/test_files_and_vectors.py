"""Token files, fill-in-middle and whitening against brute force."""
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import fill_in_middle, token_files, whitening
from tests.llm.conftest import sentence


def tokenizer_path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# ---- token files ----------------------------------------------------------------------------

TEXTS = ["a  b", " lead", "trail ", "\n\n x\ty ", "it's  we'll\n I'm", "<|endoftext|> a<|endoftext|>b  <|endoftext|>", "é à ​ a　b \x1c c \x85 d",
         "x" * 5000 + " y", "tab\t tab", "a\r\n b", " ", "12 345 6", "... , ;; :", "x don't, don't' a_b a_, x² ½ y½ ²x, q<|endoftext|>, w< v<| a(b) c)). d!! ''ll Éa, ñandú; ß. ǅx: ɐ̈y ٣ x٣,", "ひらがな 漢字 \U0001f642 \U0001f642", "a b"]


def test_pieces_are_the_library(rows):
    from tokenizers import Tokenizer
    library, own = Tokenizer.from_file(tokenizer_path()), token_files.Pieces(tokenizer_path())
    assert own.by_piece
    rng = random.Random(4)
    odd = ["".join(rng.choice("ab é\t\n .,'s1<|>　\x1c") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    for t in [*(t or "" for _, t in rows), *TEXTS, *odd]:
        for _ in range(2):  # remembered, too
            assert own.encode(t) == own._encode(t)
            assert np.frombuffer(own.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_of_several_texts(rows, monkeypatch):
    """Texts taken together have the library's ids, whatever their number, nulls and odd white space."""
    import pyarrow as pa
    from tokenizers import Tokenizer
    library, own = Tokenizer.from_file(tokenizer_path()), token_files.Pieces(tokenizer_path())
    rng = random.Random(6)
    odd = ["".join(rng.choice("abA é\n\n .,'s1<") for _ in range(rng.randint(1, 40))) for _ in range(600)]
    texts = [None, "", *(t for _, t in rows), *TEXTS, *odd, None, "x.\nThe 'll\n'll y", "<|endoftext|>\n<|endoftext|> a.\n<|endoftext|>"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for most in (1, 300, 1 << 22):
        monkeypatch.setattr(token_files, "TOGETHER", most)
        every = pa.array(["skipped", *texts], pa.string()).slice(1)
        assert [np.frombuffer(ids, "<u4").tolist() for ids in own.encode_all(every)] == want
    assert list(own.encode_all(pa.array([], pa.string()))) == [] and list(own.encode_all(pa.array([None, ""], pa.string()))) == [b"", b""]


def test_pieces_over_line_ends_are_remembered():
    """The lines of a piece are looked up by themselves: known ones are not encoded again."""
    own = token_files.Pieces(tokenizer_path())
    assert own.by_line
    own.encode("a alpha. beta\nGamma, x.\nDelta. delta\nEnd")
    own._word = own._encode = own.split = own.model = None  # nothing is left that could encode
    assert own.now["alpha.\nGamma,"] == own.now["alpha."] + own.now["\nGamma,"]
    assert own.now["beta\nDelta.\nEnd"] == own.now["beta"] + own.now["\nDelta."] + own.now["\nEnd"]


def test_pieces_forget(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 5)
    own, fresh = token_files.Pieces(tokenizer_path()), token_files.Pieces(tokenizer_path())
    rng = random.Random(5)
    for _ in range(50):
        t = sentence(rng, 9)
        assert own.encode(t) == fresh._encode(t) and len(own.now) <= 6 and len(own.before) <= 6


def test_coder_round_trip_and_damage():
    rng = np.random.default_rng(2)
    for n, vocabulary in ((0, 1), (1, 1), (1023, 2), (1024, 3), (1025, 300), (40_000, 5000), (3000, 1)):
        ids = (rng.zipf(1.3, n) % vocabulary * 17 + 5).astype(np.uint32)
        found, counts = np.unique(ids if n else np.array([7], np.uint32), return_counts=True)
        table = token_files.Table.scaled(found, counts)
        assert table.freq.sum() == 1 << table.bits and (table.freq > 0).all()
        docs = np.array([(1, n // 2, 9), (0, n - n // 2, 0)], token_files.DOCUMENT)
        data = token_files.pack_block(3, 4, 1 << 40, docs, ids, table)
        part, block, before, back, out, used = token_files.unpack_block(memoryview(data + b"\nrest"), table)
        assert (part, block, before, used) == (3, 4, 1 << 40, len(data)) and (back == docs).all() and (out == ids).all()
        for at in sorted({0, 9, 20, len(data) // 2, len(data) - 1}):
            broken = bytearray(data)
            broken[at] ^= 4
            with pytest.raises(ValueError):
                token_files.unpack_block(memoryview(bytes(broken)), table)
        with pytest.raises(ValueError):
            token_files.unpack_block(memoryview(data[:-1]), table)
    # the words come close to the entropy of the ids
    ids = rng.choice(4, 200_000, p=[.7, .2, .07, .03]).astype(np.uint32)
    table = token_files.Table.scaled(*np.unique(ids, return_counts=True))
    p = np.bincount(ids) / len(ids)
    assert 32 * len(token_files.rans_encode(ids, table)[1]) < 1.01 * -(p * np.log2(p)).sum() * len(ids)
    with pytest.raises(ValueError):
        token_files.rans_encode(np.array([9], np.uint32), table)


def test_token_files(spark, docs, rows, empty, tmp_path, monkeypatch):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_path())
    monkeypatch.setattr(token_files, "BLOCK", 300)  # many blocks
    table = docs.select("doc_id", "text").union(spark.createDataFrame(
        [(None, "no id"), (None, None), (4, "same id"), (4, "same id"), (10 ** 15, "far"), (-3, "below")], "doc_id long, text string")).withColumn("start", F.lit(1))
    path = token_files.write(table, f"file://{tmp_path}/tokens", tokenizer_path(), 2)
    got = token_files.read(spark, path).collect()
    want = sorted(((i is not None, i or 0, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in ((r.doc_id, r.text) for r in table.collect())), key=lambda r: r[:2])
    got.sort(key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [w[:2] for w in want]  # ascending ids, nulls first
    at = 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(ids)
        at += len(ids)
    key = lambda r: (r[0], r[1], r[2])
    assert sorted(((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=key) == sorted(want, key=key)
    for start, stop in ((0, 1), (at // 3, at // 3 + 40), (at - 1, at + 9), (at, at + 5), (5, 5)):
        some = sorted(r.start for r in token_files.read_range(spark, path, start, stop).collect())
        assert some == sorted(r.start for r in got if r.start < stop and r.start + r.n_tokens > start)
    # in the files themselves parts and blocks ascend
    places = [(int(re.search(r"part=(\d+)", r.path).group(1)), r.head) for r in spark.read.format("binaryFile").load(f"{path}/ids").select("path", F.substring("content", 1, 4).alias("head")).collect()]
    assert places and all(bytes(head) == token_files.MAGIC for _, head in places)
    nothing = token_files.write(empty, f"file://{tmp_path}/nothing", tokenizer_path(), 2)
    assert token_files.read(spark, nothing).count() == 0 and token_files.read_range(spark, nothing, 0, 9).count() == 0


# ---- fill in the middle ---------------------------------------------------------------------

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def in_middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or re.search("<P>|<S>|<M>", text) or c % 100 >= 90:
        return n, "plain", None, None, text
    i, j = sorted((a % (n + 1), b % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:i], units[i:j], units[j:]))
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if d % 100 < 20 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_skip_list():
    rng = random.Random(1)
    for _ in range(800):
        t = "".join(rng.choice("aZb@[`{ é\n\U0001f64219<") for _ in range(rng.randint(0, rng.choice([3, 40, 900]))))
        units, s = UNIT.findall(t), fill_in_middle.SkipList(fill_in_middle._points(t))
        assert s.units == len(units)
        for cut in {0, len(units), rng.randint(0, len(units))}:
            assert s.code_points_before(cut) == len("".join(units[:cut]))
    long = fill_in_middle.SkipList(fill_in_middle._points("ab " * 100_000))
    assert long.units == 200_000 and 6 <= len(long.lanes) <= 12 and long.code_points_before(100_001) == 150_002
    for _, units, chars in long.lanes:  # every lane spans the text
        assert units.sum() == 200_000 and chars.sum() == 300_000
    with pytest.raises(IndexError):
        long.code_points_before(200_001)


def test_fill_in_middle(spark, docs, rows, empty):
    extra = [(k, sentence(random.Random(k), 5 + k % 40)) for k in range(1000, 1200)]
    odd = [(None, "no id at all"), (7, "has <P> in it"), (8, "<S>"), (9, "x<M"), (9, "x<M"), (10, "<" * 40), (11, "é\n\U0001f642" * 30), (12, "word " * 60_000)]
    table = spark.createDataFrame([(i, t, f"<{i}>", 5, "b") for i, t in [*rows, *extra, *odd]], "doc_id long, text string, lang string, n long, row string")
    out = fill_in_middle.transform(table)
    assert out.columns == ["doc_id", "lang", "row", "n", "form", "prefix_chars", "middle_chars", "output"]
    out = out.withColumn("restored", fill_in_middle.restored(F.col("form"), F.col("output"))).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[-1])
    got = sorted(((r.doc_id, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output), r.restored) for r in out), key=key)
    assert got == sorted(((i, in_middle(i, t), t or "") for i, t in [*rows, *extra, *odd]), key=key)
    assert all(r.lang == f"<{r.doc_id}>" and r.row == "b" for r in out) and {r.form for r in out} == {"plain", "psm", "spm"}
    assert fill_in_middle.transform(empty).count() == 0
    assert fill_in_middle.transform(docs.select("text", F.lit(3).alias("id")), id_col="id").columns[0] == "id"


# ---- whitening ------------------------------------------------------------------------------

def vectors(spark, data, kind="float"):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in data], f"vec_id long, embedding array<{kind}>, x long, n long")


def brute_force(data, k=4):
    rows = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in data if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fits = np.array(sorted({tuple(x) for _, x in rows}), float)
    n, mean = len(fits), fits.mean(axis=0)
    e, u = np.linalg.eigh((fits - mean).T @ (fits - mean) / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    sums = [sum(int(c) for c in col) for col in fits.T]
    return rows, n, sums, mean, e, u, np.trace((fits - mean).T @ (fits - mean) / n)


@pytest.mark.parametrize("dimension", [3, 24])
def test_whitening(spark, dimension):
    rng = np.random.default_rng(dimension)
    data = [(i, (rng.standard_normal(dimension) * (2.0 ** -(np.arange(dimension) % 5))).astype(np.float32).tolist()) for i in range(400)]
    data += [(1000 + i, data[3][1]) for i in range(300)]  # a third are copies: they count once
    data += [(2000, None), (2001, [None] * dimension), (2002, [float("nan")] + [0.0] * (dimension - 1)), (2003, [float("-inf")] * dimension), (None, data[5][1]), (3, data[3][1])]
    rows, n, sums, mean, e, u, trace = brute_force(data)
    got = whitening.whiten(vectors(spark, data).repartition(3)).collect()
    k = min(4, dimension)
    assert len(got) == len(rows) * k
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    signs = {}
    for i, x in rows:
        for r in by[i]:
            c = r.component - 1
            z = (np.array(x) - mean) @ u[:, c] / np.sqrt(e[c])
            if abs(z) > 0.1:
                assert signs.setdefault(c, np.sign(z * r.whitened)) == np.sign(z * r.whitened)
            assert abs(abs(z) - abs(r.whitened)) < 1e-9 and abs(r.explained - e[c] / trace) < 1e-12
            assert r.n == n and r.identity_error < 1e-10 and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))


def test_whitening_of_odd_tables(spark):
    none = lambda data, kind="float": whitening.whiten(vectors(spark, data, kind)).collect() == []
    assert none([]) and none([(1, None), (2, [None])]) and none([(1, []), (2, [])]) and none([(1, [0.5, 2.0])]) and none([(1, [1.0, 2.0])] * 3)
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(5)])).collect()  # one direction
    assert {r.component for r in flat} == {1} and len(flat) == 5 and abs(flat[0].explained - 1) < 1e-12
    mixed = whitening.whiten(vectors(spark, [(i, [float(i), float(i * i)]) for i in range(6)] + [(9, [1.0]), (10, [])])).collect()
    assert {r.vec_id for r in mixed} == set(range(6)) and {r.component for r in mixed} == {1, 2}
    big = whitening.whiten(vectors(spark, [(i, [1e12 * i, -1.0 * i]) for i in range(3)], "double")).collect()
    assert all(r.deviation is None for r in big if r.vec_id != 1) and any(r.whitened for r in big)


def test_solver_spectra():
    rng = np.random.default_rng(0)
    spectra = [np.ones(10), np.r_[np.full(5, 5.0), np.ones(3), np.zeros(6)], np.r_[7.0, np.zeros(29)], np.r_[1e6, 1e3, 1, 1e-3, np.zeros(16)],
               np.r_[np.ones(100), 1 - 1e-9 * np.arange(60)], rng.random(64) + 1, np.zeros(6) + 1e-30]
    for spectrum in spectra:
        d = len(spectrum)
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        v = q * spectrum @ q.T
        e, u = whitening.jacobi_davidson(lambda w, v=v: v @ w, d, 4)
        assert np.allclose(e, np.sort(spectrum)[::-1][:4], rtol=0, atol=1e-13 * spectrum.max())
        assert np.abs(v @ u - u * e).max() <= 1e-12 * spectrum.max() and np.abs(u.T @ u - np.eye(4)).max() < 1e-13


def test_minres_solves():
    rng = np.random.default_rng(3)
    m = rng.standard_normal((12, 12))
    m, b = m + m.T, rng.standard_normal((12, 3))
    assert np.abs(m @ whitening.minres(lambda z: m @ z, b, 30) - b).max() < 1e-6
