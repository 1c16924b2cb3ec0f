"""Every query against SQL, a library, or a plain program for the same result."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from firmloom.llm import chat, decontaminate, fm_dedup, packing, pseudo_likelihood, resample, secrets, simhash, token_counts, voronoi
from firmloom.llm import queries as Q
from firmloom.llm.common import stored
from firmloom.llm.oracles import ORACLES
from firmloom.llm.packing import pack_histogram

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in Q.table(spark, SF, "documents").select("doc_id", "text").collect()}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    frame = Q.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    columns = sorted(frame.columns)
    result = con.execute(f"select {', '.join(columns)} from ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, frame.select(columns).collect())) == sorted(result)


def test_secrets(spark, texts):
    for row in Q.op2_secret_scan(spark, SF).collect():
        text = texts[row.doc_id]
        found = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 8]
        found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
        joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == n for _, k, _ in found) for n in range(3)]
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(row.spans.split(","))


def test_formats_generalise():
    random.seed(1)
    hexes = ["".join(random.choices("0123456789abcdef", k=40)) for _ in range(300)]
    words_ = ["".join(random.choices(["the", "re", "on", "sch", "tion", "er"], k=9)) for _ in range(200)]
    pairs = np.zeros((secrets.WIDTH, secrets.WIDTH))
    for w in words_[:100] + ["20240131", "4111111111111111"] * 20:
        codes = [secrets.NUMBER[ord(c)] for c in w]
        for a, b in zip(codes, codes[1:]):
            pairs[a, b] += 1
    formats = secrets.fit([("hex", h) for h in hexes[:200]], pairs)
    assert len(formats.automata) == 1
    assert np.mean([formats.likely(h[:28]) for h in hexes[200:]]) > 0.9
    assert not any(formats.likely(w) for w in words_[100:])
    assert not secrets.fit([("hex", h) for h in hexes[:5]], pairs).likely(hexes[0])


def test_chat(spark):
    turns = defaultdict(list)
    for r in Q.table(spark, SF, "conversations").collect():
        turns[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    turns[-7] = [(0, "user", "\\### Assistant: </turn> ok"), (1, "assistant", "\\### Assistant: </turn> ok")]
    rows = Q.op4_chat_windows(spark, SF).collect()
    assert {r.conv_id for r in rows} == set(turns)
    for r in rows:
        said = sorted(turns[r.conv_id])
        learnt = "".join(t for _, role, t in said if role == "assistant")
        assert r.n_turns == len(said)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in said).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())


def print_of(text, n):
    parts = words(lower(text))
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + n]) for i in range(max(1, len(parts) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, distance):
    root = {i: i for i in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= distance:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {i: top(i) for i in prints}


def test_simhash(spark, texts):
    prints = {i: print_of(t, 4) for i, t in texts.items()}
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in Q.op5_simhash_dedup(spark, SF).collect()}
    near = groups(prints, 4)
    assert found == {i: (f"{p:016x}", near[i]) for i, p in prints.items()}


@pytest.mark.parametrize("distance", [4, 6])
def test_links_lose_none(spark, distance):
    random.seed(distance)
    prints = set()
    for _ in range(60):
        base = random.getrandbits(64)
        for _ in range(6):
            prints.add(base ^ sum(1 << b for b in random.sample(range(64), random.randint(0, distance))))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = simhash.links(spark.createDataFrame(signed, "fp long"), distance).collect()
    pairs = Counter(frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in found)
    want = {frozenset(p) for p in itertools.combinations(prints, 2) if (p[0] ^ p[1]).bit_count() <= distance}
    assert set(pairs) == want and set(pairs.values()) <= {1}


def test_resampling(spark):
    rows = {r.doc_id: r.kept for r in Q.op6_importance_resampling(spark, "/root/testdata/sf0.01").collect()}
    labels = Q.table(spark, "/root/testdata/sf0.01", "labels").collect()
    good = [rows[r.doc_id] for r in labels if r.quality == 1 and r.toxic == 0 and r.doc_id in rows]
    bad = [rows[r.doc_id] for r in labels if (r.quality == 0 or r.toxic == 1) and r.doc_id in rows]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_kth_largest(spark):
    random.seed(4)
    values = [random.getrandbits(48) for _ in range(200)] + [12345] * 50
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in (1, 7, 100, 220, 250):
        assert resample.kth_largest(df, "v", k) == sorted(values)[-k]


def test_token_counts(spark, texts):
    library = Tokenizer.from_file(Q.BYTE_VOCABULARY)
    for r in Q.op7_token_counts(spark, SF).collect():
        text = texts[r.doc_id]
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 512)
        counts = token_counts.counts_of(bytes(r.prefix_deltas))
        assert len(counts) == len(text)
        for at in random.sample(range(len(text)), min(3, len(text))):
            assert counts[at] == len(library.encode(text[: at + 1], add_special_tokens=False).ids)
        assert r.chars_in_budget == token_counts.cut_at(bytes(r.prefix_deltas), 512)


def test_every_prefix():
    random.seed(3)
    library, counter = Tokenizer.from_file(Q.BYTE_VOCABULARY), token_counts.PrefixCounter(Q.BYTE_VOCABULARY)
    parts = ["a", "the", " ", "  ", "\n", "\n\n", "'re", "'s", "'", "é", "é", "1", ".", "!!", "\t", " ", "\x85", "\x1c", " ", "😀", "日本", "²", "<|endoftext|>", "<|end", "\r\n"]
    for _ in range(400):
        text = "".join(random.choices(parts, k=random.randint(0, 9)))
        want = [len(library.encode(text[: i + 1], add_special_tokens=False).ids) for i in range(len(text))]
        assert np.cumsum(counter.deltas(text), dtype=np.int64).tolist() == want, text


def test_knn_with_many_cells(spark):
    random.seed(5)
    rows = [(i, [float(random.randint(-3, 3)) for _ in range(4)]) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, vec array<double>")
    found = voronoi.knn_join(vectors, vectors.where("vec_id % 10 = 0"), 5, pivots=9, slice_rows=20, query_rows=7)
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    at = dict(rows)
    for q in range(0, 300, 10):
        best = sorted((-sum(a * b for a, b in zip(at[q], v)), i) for i, v in rows if i != q)[:5]
        assert got[q] == [i for _, i in best]


def test_packing(spark, texts):
    library = Tokenizer.from_file(Q.WORD_VOCABULARY)
    ids = {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in Q.op9_shortest_pack_first(spark, SF).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for found, total in [(pieces[i], len(x)) for i, x in ids.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == total if total else at <= 4096
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(map(len, ids.values())) / 4096 / len(sequences) > 0.9


def test_word_ids():
    import pyarrow as pa

    random.seed(6)
    library, own = Tokenizer.from_file(Q.WORD_VOCABULARY), packing.WordIds(Q.WORD_VOCABULARY)
    parts = ["The", "naïve", "ÉTÉ", " ", "\n", " ", "'re", "x's", "12", "½", "²", "İ", "Σ", "日本", "<|endoftext|>", "...", "a-b", "\x1f", "ﬁ", "é"]
    for _ in range(400):
        text = "".join(random.choices(parts, k=random.randint(0, 8)))
        found = np.frombuffer(next(own.batch_ids(pa.array([text]))), "<u4").tolist()
        assert found == library.encode(text, add_special_tokens=False).ids, text


def test_histogram_packing():
    random.seed(7)
    for case in ({5: 1000}, {100: 7, 3: 2, 1: 5}, {n: random.randint(0, 9) for n in range(1, 65)}, {33: 10**9, 31: 10**9, 1: 3}):
        case = {n: c for n, c in case.items() if c}
        patterns, placed = pack_histogram(case, 64 if max(case) <= 64 else 128), Counter()
        for p in patterns:
            at = 0
            for length, copies, offset in p.runs:
                assert offset == at
                at += length * copies
                placed[length] += copies * p.count
            assert at == p.used
        assert placed == case


def test_windows_of_hot_anchors(spark, texts):
    docs = Q.table(spark, SF, "documents")
    plain = {r.doc_id: r.kept_sha256 for r in fm_dedup.without_repeats(docs, 35).collect()}
    split = {r.doc_id: r.kept_sha256 for r in fm_dedup.without_repeats(docs, 35, shard_passages=50, most=1).collect()}
    assert plain == split


def test_intervals():
    random.seed(2)
    for _ in range(15):
        width, kinds = random.choice([9, 12, 35]), random.choice([2, 3, 30])
        docs = []
        for _ in range(5):
            base = [b"w%d" % random.randint(0, kinds) for _ in range(random.randint(0, 120))]
            docs += [base, base[random.randint(0, 30) :] + [b"x"], [b"y"] + base[:50]]
        times = Counter(tuple(d[i : i + width]) for d in docs for i in range(len(d) - width + 1))
        want = [{p for i in range(len(d) - width + 1) if times[tuple(d[i : i + width])] > 1 for p in range(i, i + width)} for d in docs]
        shards, got = defaultdict(list), [set() for _ in docs]
        for n, h in enumerate(fm_dedup.word_hashes(docs)):
            for anchor, first, size in zip(*[x.tolist() for x in fm_dedup.anchor_runs(h, width)]):
                shards[anchor % 3].append((n, first, b" ".join(docs[n][first : first + size + width - 1])))
        for rows in shards.values():
            for (n, first, _), found in zip(rows, fm_dedup.shard_intervals([r[2] for r in rows], width)):
                for a, b in found:
                    got[n].update(range(first + a, first + b))
        assert got == want


def test_pseudo_likelihood_learns(spark):
    rows = [(i, " ".join(random.Random(i).choice(["red apple pie", "green pear tart", "blue plum cake"]) for _ in range(60))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    tokens = pseudo_likelihood.learn_vocabulary(docs)
    encoded = stored(pseudo_likelihood.encode(docs, tokens), "test")
    flat = pseudo_likelihood.train(encoded, rounds=3, share=2, batch=128)
    mixed = spark.createDataFrame([(i, " ".join(random.Random(i).sample(t.split(), len(t.split())))) for i, t in rows], "doc_id long, text string")
    seen = pseudo_likelihood.score(encoded, flat).groupBy().avg("mean_pll").first()[0]
    odd = pseudo_likelihood.score(pseudo_likelihood.encode(mixed, tokens), flat).groupBy().avg("mean_pll").first()[0]
    assert seen > -1.0 and odd < seen - 1.0


def plain_near(texts, items, width, slop):
    """Places of each window's rarest word (of equals the first) that have all its other words within reach."""
    docs = {d: [w.decode() for w in decontaminate.words_of(t.encode())] for d, t in texts.items()}
    times = Counter(w for words in docs.values() for w in words)
    found = set()
    for item, text in items:
        words = [w.decode() for w in decontaminate.words_of(text.encode())]
        for k in range(max(1, len(words) - width + 1) if words else 0):
            window = words[k : k + width]
            lead = min(window, key=lambda w: (times[w], window.index(w)))
            for d, ws in docs.items():
                for at in (i for i, w in enumerate(ws) if w == lead):
                    near = set(ws[max(0, at - len(window) - slop) : at + len(window) + slop + 1])
                    if set(window) <= near:
                        found.add((d, item, at))
    return found


@pytest.mark.parametrize("slop", [0, 3, 100])
def test_proximity_by_every_window(spark, slop):
    rng = random.Random(slop)
    vocabulary = [f"w{i}" for i in range(25)] + ["rare1", "rare2"]
    weights = [10] * 25 + [1, 1]
    texts = {d: " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 5, 300]))) for d in range(30)}
    items = [(str(i), " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 3, 6, 12])))) for i in range(25)]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    index = stored(decontaminate.build_index(docs), "index")
    table = spark.createDataFrame(items, "item_id string, text string")
    want = plain_near(texts, items, 4, slop)
    for block in (16 << 20, 300):  # one block of items, and many
        rows = decontaminate.phrase_matches(index, table, 4, slop, block_bytes=block).collect()
        assert {(r.doc_id, s.item_id, s.start) for r in rows for s in r.spans} == want
        assert len(rows) == len(texts)


def test_phrases_in_many_blocks(spark, texts):
    """More than one block of items, and rows that repeat: the same result as in one block."""
    docs = Q.table(spark, SF, "documents").select("doc_id", "text")
    docs = docs.union(docs.where("doc_id % 7 = 0"))
    index = stored(decontaminate.build_index(docs), "index")
    items = Q.table(spark, SF, "benchmark")
    result = lambda block: sorted(
        (r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), tuple(sorted(map(tuple, r.spans))))
        for r in decontaminate.phrase_matches(index, items, 10, block_bytes=block).collect()
    )
    one, many = result(16 << 20), result(500)
    assert one == many and any(n for _, _, n, _, _ in one)


def test_long_conversation(spark):
    """Thousands of turns in one conversation: every turn read back once, in order."""
    rows = [(1, t, "user" if t % 2 else "assistant", f"some words here {t}") for t in range(4000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.format_windows(turns, budget=256, history=64)
    read = sorted(chat.read_windows(windows).collect(), key=lambda r: r.window)
    assert len(read) > 100 and [tuple(t) for r in read for t in r.turns] == [r[2:] for r in rows]
    assert [t for r in read for t in r.targets] == [r[3] for r in rows if r[2] == "assistant"]


@pytest.mark.parametrize("clusters, skipped", [(True, 0.3), (False, -1e-9)])
def test_nearest_by_every_pair(spark, caplog, clusters, skipped):
    """Cells that hold nothing nearer are skipped, where vectors lie in clusters many of them."""
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 8))
    centres *= 200 / np.linalg.norm(centres, axis=1)[:, None]
    x = np.round(centres[rng.integers(0, 40, 2000)] + rng.standard_normal((2000, 8)) * 3 if clusters else rng.standard_normal((2000, 8)) * 100)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vec array<double>").repartition(3)
    with caplog.at_level("INFO", logger="firmloom.llm.voronoi"):
        rows = voronoi.knn_join(df, df.where("vec_id % 25 = 0"), 5, slice_rows=300, query_rows=30).collect()
    want = set()
    for q in range(0, 2000, 25):
        scores = x @ x[q]
        best = sorted((-scores[j], j) for j in range(2000) if j != q)[:5]
        want |= {(q, n, j, -s) for n, (s, j) in enumerate(best, 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in rows} == want
    assert float(caplog.records[-1].getMessage().split()[0]) > skipped
