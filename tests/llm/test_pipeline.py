"""The pipeline's stages after the classifier against plain programs, each on what the one before kept."""

import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from firmloom.llm import queries as Q
from firmloom.llm import secrets

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def print_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def one_of_each_group(texts):
    prints = {d: print_of(t) for d, t in texts.items()}
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: texts[d] for d in texts if find(d) == d}


def windows(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    return words, {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))} if words else set()


def without_items(texts, items):
    wanted = set().union(*[windows(t)[1] for t in items])
    sizes = {len(w) for w in wanted}

    def clean(text):
        words, _ = windows(text)
        return not any(tuple(words[i : i + n]) in wanted for n in sizes for i in range(len(words) - n + 1))

    return {d: t for d, t in texts.items() if clean(t)}


def without_secrets(text):
    found = sorted((a, b) for a, _, b, _ in secrets.base_spans(text))
    out, at = [], 0
    for a, b in found:
        if a >= at:
            out += [text[at:a], "[secret]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def test_stages_by_plain_programs(spark, tmp_path):
    docs, kept = Q.table(spark, SF, "documents"), []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        kept.append(docs.collect())
    texts = [{r.doc_id: r.text or "" for r in rows} for rows in kept[:-1]]
    whole = {r.doc_id: r.text or "" for r in Q.table(spark, SF, "documents").collect()}
    assert texts[0].items() <= whole.items() and 0.7 * len(whole) < len(texts[0]) < len(whole)
    assert texts[1] == one_of_each_group(texts[0]) and len(texts[1]) < len(texts[0])
    items = [r.text for r in Q.table(spark, SF, "benchmark").collect()]
    assert texts[2] == without_items(texts[1], items)
    assert texts[3] == {d: without_secrets(t) for d, t in texts[2].items()}
    library = Tokenizer.from_file(Q.WORD_VOCABULARY)
    places, pieces = defaultdict(list), defaultdict(list)
    for r in kept[4]:
        ids = library.encode(texts[3][r.doc_id], add_special_tokens=False).ids + [2]
        part = ids[r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes()) and r.doc_tokens == len(ids)
        pieces[r.doc_id].append((r.start, r.length, len(ids)))
        places[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == texts[3].keys()
    for found in pieces.values():
        assert sum(n for _, n, _ in found) == found[0][2]
    for found in places.values():
        ends = [a + n for a, n in sorted(found)]
        assert [a for a, _ in sorted(found)] == [0, *ends[:-1]] and ends[-1] <= 4096
