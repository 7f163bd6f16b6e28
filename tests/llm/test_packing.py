import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from perispark.llm import packing
from tests.llm.helpers import DOCS, documents, edge_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def best_sum(lengths, room):
    reach = {0}
    for n in lengths:
        reach |= {r + n for r in reach if r + n <= room}
    return max(reach)


def test_fill_comes_as_close_as_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 60): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        chosen = packing.fill(counts, 64)
        largest = max(counts)
        rest = [n for n, c in counts.items() for _ in range(c - (n == largest))]
        assert chosen[largest] >= 1 and all(chosen[n] <= counts[n] for n in chosen)
        assert sum(n * k for n, k in chosen.items()) == largest + best_sum(rest, 64 - largest)


def test_patterns_use_every_piece_once():
    counts = {2048: 5, 2000: 3, 48: 2, 7: 1000, 1: 13}
    used = {}
    for chosen, times in packing.patterns(counts, 2048):
        assert sum(n * k for n, k in chosen.items()) <= 2048
        for n, k in chosen.items():
            used[n] = used.get(n, 0) + k * times
    assert used == counts


def check(rows, texts, capacity):
    library = Tokenizer.from_file(PATH)
    whole = sorted(tuple(library.encode(t or "", add_special_tokens=False).ids + [1]) for t in texts)
    at, total = {}, 0
    for r in rows:
        at.setdefault(r.sequence_id, []).append(r)
        total += r.length
    for pieces in at.values():
        end = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= capacity
    assert total == sum(map(len, whole))
    crcs = sorted((len(ids), s, min(capacity, len(ids) - s), zlib.crc32(np.array(ids[s:s + capacity], dtype="<u4").tobytes())) for ids in whole for s in range(0, len(ids), capacity))
    assert sorted((r.doc_tokens, r.start, r.length, r.ids_crc32) for r in rows) == crcs
    return total / (capacity * len(at))


def test_every_id_is_in_one_piece(spark):
    rows = packing.pack(documents(spark), PATH, capacity=64).collect()
    assert check(rows, [r[1] for r in edge_documents()], 64) > 0.97
    assert rows[0].asDict().keys() == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


def test_production_capacity_and_hot_length(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i} " * (i % 50), "en", "s", 1) for i in range(600)]
    found = packing.pack(spark.createDataFrame(rows, DOCS), PATH).collect()
    assert check(found, [r[1] for r in rows], 2048) > 0.9


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), PATH).count() == 0


def test_special_token_and_white_space_as_the_library():
    library, encode = Tokenizer.from_file(PATH), packing.library_encoder(PATH)
    for text in ("a <|endoftext|> b", "  a  b", "\x1c a \x85 b　c", "🙂 é\n \n x", "don't  1234"):
        assert np.frombuffer(encode(text), dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_runs_of_white_space_as_the_library():
    library, encode = Tokenizer.from_file(PATH), packing.library_encoder(PATH)
    for text in (" " * 1_200_000, "a" + "\n" * 1_200_000 + "b", "x " + " \n" * 600_000 + "y <|endoftext|> z"):
        assert np.array_equal(np.frombuffer(encode(text), dtype="<u4"), library.encode(text, add_special_tokens=False).ids)
