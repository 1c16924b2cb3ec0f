"""Token blocks, whitening and conversation repair against libraries and plain programs."""

import functools
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from firmloom.llm import feast, repair, token_blocks, whitening
from firmloom.llm import queries as Q
from firmloom.llm.queries import BYTE_VOCABULARY

SF = "/root/testdata/sf0.001"

# ---- token blocks


def test_packed_ids_come_back():
    draw = np.random.default_rng(1)
    for n in (0, 1, 127, 128, 129, 5000):
        ids = draw.integers(0, 50257, n).astype("<u4")
        if n > 200:
            ids[5], ids[128:256], ids[300] = 2**32 - 1, 7, 0
        segment = token_blocks.Segment(token_blocks.write_segment(ids, [(1, True, 0, n, n)]))
        assert (segment.ids() == ids).all()
        for a, b in draw.integers(0, n + 3, (20, 2)):
            assert (segment.ids(int(a), int(b)) == ids[a : max(a, b)]).all()
    flat = np.full(1280, 40000, dtype="<u4")
    assert len(token_blocks.pack_ids(flat)[1]) == 10 * token_blocks.BLOCK_HEAD
    flat[::100] += 3  # two or so patches a block cost less than two more bits for all
    assert len(token_blocks.pack_ids(flat)[1]) <= 10 * token_blocks.BLOCK_HEAD + 26


def test_checksum_of_parts():
    data = random.Random(2).randbytes(1000)
    for cuts in ([0, 1000], [0, 3, 1000], [0, 1, 500, 777, 1000]):
        shares = [token_blocks.crc_share(data[a:b], a, 1000) for a, b in zip(cuts, cuts[1:])]
        assert functools.reduce(lambda a, b: a ^ b, shares) == zlib.crc32(data)


ODD = [
    "a  b", " a", "a ", "a\n\nb", "a\nb", "it's don't we'll x", "<|endoftext|> x", "x <|endoftext|>", "a\tb", "日本 語\n\n", "", "\n", " ",
    "a \n b", "é ü z  ", "\x01a b", "a\x0bb c", "a \x85 b", "x\r\ny z", "a b c  d", "A1b2 c3.d4, (e) --", "w" * 5000 + " end", "ünïcödé wörd, größe. über\nÄrger! naïve42 l'été «où» ßß", "﻿x y",
]


def test_chunks_encode_like_the_library():
    library, coder = Tokenizer.from_file(BYTE_VOCABULARY), token_blocks.ChunkIds(BYTE_VOCABULARY, room=50)
    import pyarrow as pa

    for found, text in zip(coder.batch(pa.array(ODD * 2)), ODD * 2):
        assert np.frombuffer(found, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, text


def plain_blocks(rows, library):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_documents_read_back(spark):
    rows = [(r.doc_id, r.text) for r in Q.table(spark, SF, "documents").collect()]
    found = sorted(tuple(r) for r in Q.op11_token_blocks(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert found == sorted(plain_blocks(rows, Tokenizer.from_file(BYTE_VOCABULARY)))


def test_token_block_edges(spark, tmp_path, monkeypatch):
    long = " ".join(f"word{i % 977} and" for i in range(300_000))  # more ids than a segment holds
    rows = [(None, "no id"), (1, "same"), (1, "same"), (2, None), (3, ""), (5, long), (9, "żółć 日本 \U0001f600")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.select("*", *[F.lit(1).alias(c) for c in ("key", "row", "piece", "part", "start", "ids")])
    monkeypatch.setattr(token_blocks, "PART_BYTES", 250_000)  # several range partitions
    path = f"{tmp_path}/blocks"
    token_blocks.write_token_blocks(docs, path, BYTE_VOCABULARY)
    found = [tuple(r) for r in token_blocks.read_documents(spark, path).orderBy("start").collect()]
    want = plain_blocks(rows, Tokenizer.from_file(BYTE_VOCABULARY))
    assert found == want
    assert token_blocks.segments(spark, path).select("part").distinct().count() > 1
    library = Tokenizer.from_file(BYTE_VOCABULARY).encode(long, add_special_tokens=False).ids
    at = want[5][1]
    some = token_blocks.read_range(spark, path, at + 524_000, 600).orderBy("position").collect()
    assert [r.id for r in some] == library[524_000:524_600] and some[0].position == at + 524_000
    assert token_blocks.encode_documents(docs.limit(0), BYTE_VOCABULARY).collect() == []


# ---- whitening

SPECTRA = {
    "random": lambda n, draw: draw.random(n) * 100,
    "equal": lambda n, draw: np.ones(n),
    "half": lambda n, draw: np.where(np.arange(n) < n // 2, 0, 5.0),
    "steep": lambda n, draw: 10.0 ** -np.arange(n).clip(0, 14),
    "close": lambda n, draw: 1 + 1e-9 * draw.random(n),
    "tied": lambda n, draw: np.r_[[7.0] * min(n, 10), draw.random(max(0, n - 10))],
}


@pytest.mark.parametrize("kind", SPECTRA)
@pytest.mark.parametrize("size", [1, 2, 9, 24, 64])
def test_eigenpairs(kind, size):
    draw = np.random.default_rng(size)
    turn, _ = np.linalg.qr(draw.standard_normal((size, size)))
    matrix = (turn * SPECTRA[kind](size, draw)) @ turn.T
    matrix = (matrix + matrix.T) / 2
    values = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    found, vectors = feast.top_eigenpairs(matrix, 8)
    top = max(values[0], 1e-300)
    assert len(found) >= min(8, (values > 1e-9 * top).sum())
    assert np.abs(found - values[: len(found)]).max(initial=0) < 1e-13 * top
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max(initial=0) < 1e-13
    assert np.abs(matrix @ vectors - vectors * found).max(initial=0) < 1e-12 * top


def test_inertia():
    draw = np.random.default_rng(5)
    for size in range(1, 12):
        m = draw.standard_normal((size, size))
        m = m + m.T - np.diag(np.diag(m)) * (size % 2)  # also zero diagonals
        assert feast.positive_pivots(m) == (np.linalg.eigvalsh(m) > 0).sum()
    assert feast.positive_pivots(np.zeros((3, 3))) == 0


def plain_whitening(rows, k=8):
    x = np.floor(np.array(rows, dtype=np.float64) * 1024).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = [j for j in range(min(k, len(values))) if values[j] > 1e-13 * values.sum()]
    return deviation, centred @ (vectors[:, keep] / np.sqrt(values[keep])), values[keep] / values.sum()


def check_whitening(found, ids, rows):
    deviation, white, explained = plain_whitening(rows)
    k = white.shape[1]
    got = {(r.vec_id, r.component): r for r in found}
    assert len(found) == len(ids) * k and {r.n for r in found} == {len(rows)}
    for j in range(k):
        column = np.array([got[i, j + 1].whitened for i in ids])
        assert min(np.abs(column - white[:, j]).max(), np.abs(column + white[:, j]).max()) < 1e-8
        assert abs(got[ids[0], j + 1].explained / explained[j] - 1) < 1e-9
    assert [got[i, 1].deviation for i in ids] == deviation
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_whitening_query(spark):
    rows = [r for r in Q.table(spark, SF, "embeddings").collect() if r.embedding and all(c is not None and np.isfinite(c) for c in r.embedding)]
    check_whitening(Q.op12_feast_whitening(spark, SF).collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_whitening_edges(spark):
    draw = np.random.default_rng(4)
    rows = [(i, (draw.standard_normal(6) * [1e6, 5, 3, 1, 0.1, 0]).tolist()) for i in range(40)]
    odd = [(50, None), (51, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (52, [float("nan")] * 6), (53, [float("-inf")] * 6), (54, [])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    df = df.select("*", *[F.lit(1).alias(c) for c in ("vec", "component", "n", "whitened", "place", "i", "v")]).repartition(5)
    check_whitening(whitening.whiten(df).collect(), list(range(40)), [v for _, v in rows])
    one = spark.createDataFrame([(1, [2.0, 3.0])] * 3, "vec_id long, embedding array<double>")
    assert whitening.whiten(one).collect() == [] == whitening.whiten(df.limit(0)).collect()
    pair = spark.createDataFrame([(None, [2.0, 3.0]), (1, [2.0, 5.0]), (1, [2.0, 5.0])], "vec_id long, embedding array<float>")
    found = whitening.whiten(pair).collect()
    assert len(found) == 3 and {r.component for r in found} == {1} and found[0].explained == pytest.approx(1)
    with pytest.raises(ValueError):
        whitening.whiten(df.union(df.where("vec_id = 1").withColumn("embedding", F.array(F.lit(1.0)))))


# ---- repair


def plain_repair(rows):
    """Least (cost, audit, repaired rows) by a table over all rows and states, forwards."""
    seen, faults, blank, again, cut = set(), [], 0, 0, 0
    for _, role, text in rows:
        bare = text.strip(repair.SPACE)
        fault = "blank" if not bare else "again" if (role, text) in seen else "cut" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    turns = [t for t, *_ in rows if t is not None]
    step = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}

    def with_inserts(best):
        for _ in range(3):
            for q in list(best):
                cost, audit, back = best[q]
                to, role = step[q]
                new = (cost + 3, audit + "I", (back, f"{role}:"))
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        return best

    best = {0: (0, "", None)}
    for (_, role, text), fault in zip(rows, faults):
        then = {}

        def offer(q, cost, audit, back):
            if q not in then or (cost, audit) < then[q][:2]:
                then[q] = (cost, audit, back)

        for q, (cost, audit, back) in with_inserts(best).items():
            offer(q, cost + 4, audit + "D", back)
            if fault in ("", "cut"):
                more = 3 * (fault == "cut")
                kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((q, role[:1]))
                if kept:
                    offer(kept, cost + more, audit + "K", (back, f"{role}:{text}"))
                to, new = step[q]
                offer(to, cost + 3 + more, audit + "R", (back, f"{new}:{text}"))
        best = then
    cost, audit, back = min((v for q, v in with_inserts(best).items() if q in (0, 3)), key=lambda v: v[:2])
    lines = []
    while back:
        back, line = back
        lines.append(line)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (
        gaps, faults.count("blank"), faults.count("again"), faults.count("cut"),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(reversed(lines)).encode()).hexdigest(),
    )


def sorted_rows(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def check_repair(df, talks, **options):
    found = repair.repair(df, **options).collect()
    assert len(found) == len(talks)
    for row in found:
        assert tuple(row)[1:] == plain_repair(sorted_rows(talks[row.conv_id])), row.conv_id


TALK = "conv_id long, turn long, role string, text string"


def test_repair_by_plain_program(spark):
    draw = random.Random(6)
    talks = {None: [(1, "user", "a."), (2, "tool", "b")], -1: [(None, "assistant", "x"), (None, "", "y.")]}
    for c in range(300):
        talks[c] = [
            (draw.choice([None, t, t, t, t + 1]), draw.choice(["user", "assistant", "system", "tool", "", " ", "s"]), draw.choice(["", " \t", "a.", "b", "c! ", "d?"]) + draw.choice(["", str(t)]))
            for t in range(draw.randint(1, 12))
        ]
    rows = [(c, *r) for c, talk in talks.items() for r in talk]
    df = spark.createDataFrame(rows, TALK).select("*", *[F.lit(1).alias(x) for x in ("part", "block", "key", "codes", "kind", "at", "cost")])
    check_repair(df.repartition(7), talks)
    # the same in small blocks over many partitions
    check_repair(df.repartition(7), talks, block_rows=2, part_bytes=4096)


def test_repair_of_one_long_conversation(spark):
    draw = random.Random(7)
    talk = [(t, draw.choice(["user", "assistant", "assistant", "system"]), draw.choice(["yes.", f"t{t}.", f"n{t}", ""])) for t in range(9000)]
    df = spark.createDataFrame([(3, *r) for r in talk], TALK)
    check_repair(df, {3: talk}, part_bytes=100_000)
    check_repair(df, {3: talk})


def test_repair_edges(spark):
    rows = [(1, 0, None, None), (2, 1, "user", "hi."), (2, 1, "user", "hi."), (4, 5, "user", "long " * 500_000)]
    df = spark.createDataFrame(rows, TALK)
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,), (3,)], "conv_id long")
    found = {r.conv_id: r for r in repair.repair(df, ids).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    for c in (3, None):
        assert tuple(found[c])[1:] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert tuple(found[1])[1:] == (0, 1, 0, 0, 0, 4, "D", nothing)
    assert found[2].audit == "DD" and found[2].cost == 8 or found[2].audit in ("KDI", "KID")
    assert tuple(found[4])[1:] == plain_repair([r[1:] for r in rows[3:]])
    assert repair.repair(df.limit(0)).collect() == []


def test_damage(spark):
    rows = [(c, t, "assistant", f"One. {t}!") for c in range(30) for t in range(6)] + [(None, None, None, None)]
    found = {}
    for r in repair.damage(spark.createDataFrame(rows, TALK)).collect():
        found.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", " " if text is None else text
        want = {0: None, 1: [(role, "")], 2: [(role, text.replace(".", "").replace("!", ""))], 3: [(role, text)] * 2, 4: [("user", text)]}
        assert found.get((c, t)) == want.get(fault, [(role, text)])
