import random
import struct
import sys
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from helpers import DOCS, awkward, documents
from tokenizers import Tokenizer

import corpus_pipeline
from histkit.llm import packing
from histkit.llm.packing import WordIds, best_fit_plan, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([8, 16, 50, 512])
    items = [rng.randint(1, window) for _ in range(rng.randint(0, 400))]
    moves, ends = best_fit_plan([items.count(n) for n in range(window + 1)], window)
    placed = defaultdict(list)
    for length, low, high, each, first, offset in moves:
        for r in range(low, high):
            placed[first + (r - low) // each].append((offset + (r - low) % each * length, length))
    for pieces in placed.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= window
    free = []
    for length in sorted(items, reverse=True):
        fitting = [w for w in free if w[0] >= length]
        if fitting:
            min(fitting)[0] -= length
        else:
            free.append([window - length])
    assert sorted(window - w[0] for w in free) == sorted(u for _, n, u in ends for _ in range(n))
    assert sorted(placed) == list(range(len(free)))


def test_word_ids_equal_the_tokenizer():
    tokenizer, words = Tokenizer.from_file(PATH), WordIds(PATH, room=3)
    texts = ["Ärger's don't I'VE 12,5 <|endoftext|>x <|ENDOFTEXT|> x\x1cy\x85a b ſK İx é . .. !?", "", "日本 語 a\tb ½ ǅ the, the. the!", "a b c d e f a b c"]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert words.encode(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_word_ids_of_marks_behind_signs_equal_the_tokenizer():
    tokenizer, words = Tokenizer.from_file(PATH), WordIds(PATH)
    rng = random.Random(3)
    fixed = ["(foo).", '"foo",', '"a".', "f(x);", "x%;", "5).", "5%,", "\U0001f4a1!", "\u0915\u093f.", "e\u0301.", "a\u0323.", "(c).,", "\xe4.", "\xb2,", "it's.", "''.", ").", "<|endoftext|>.", "x<|,"]
    drawn = ["".join(rng.choice("aZ5)(\"'%.,;:!?-_\xe4\u0301\u093f\U0001f4a1") for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    for text in [*fixed, *drawn, " ".join(fixed)]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert words.encode(text) == struct.pack(f"<{len(ids)}I", *ids), text


def test_word_ids_of_letters_and_marks_equal_the_tokenizer():
    tokenizer, words = Tokenizer.from_file(PATH), WordIds(PATH)
    rng = random.Random(5)
    fixed = ["schön,", "été.!", "ß;", "naïve?!", "\xe0\xff:", "\xd7,", "\xf7.", "Ü,", "ſ,", "é's.", "<|é,", "日,"]
    drawn = ["".join(rng.choice("abzàéöøÿß÷×Ü.,;:!?'") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    for text in [*fixed, *drawn, " ".join(fixed)]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert words.encode(text) == struct.pack(f"<{len(ids)}I", *ids), text


def test_word_tables_stay_in_their_room():
    """A worker holds its table for the whole session, and an executor keeps several workers."""
    texts = [" ".join(f"w{n}x{k}" for n in range(500)) for k in range(40)]
    words = WordIds(PATH, room=1_000_000)
    before = [words.encode(t) for t in texts]
    size = sum(sys.getsizeof(x) for table in (words.new, words.old) for x in (table, *table, *table.values()))
    assert len(words.new) + len(words.old) < 15_000 and size < 2_500_000
    words.limit(100_000)
    assert not words.new and not words.old
    assert [words.encode(t) for t in texts] == before
    assert len(words.new) + len(words.old) < 1500


def test_pipeline_packs_with_small_word_tables(spark, monkeypatch):
    monkeypatch.setattr(packing, "pack", lambda docs, path, **options: options)
    assert 2 * corpus_pipeline.packed(spark, documents(spark, []), "")["room"] <= 60_000_000


def test_pieces_hold_every_id_once(spark):
    docs = awkward(spark).withColumnsRenamed({"lang": "rank", "n_chars": "part"})
    rows = pack(docs, PATH, window=64).collect()
    tokenizer = Tokenizer.from_file(PATH)
    whole = defaultdict(int)
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), 64):
            piece = ids[start : start + 64]
            whole[r.doc_id, start, len(piece), zlib.crc32(struct.pack(f"<{len(piece)}I", *piece)), len(ids)] += 1
    found, windows = defaultdict(int), defaultdict(list)
    for r in rows:
        found[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        windows[r.sequence_id].append(r)
    assert found == whole
    for pieces in windows.values():
        end = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert all(r.sequence_tokens == end for r in pieces) and end <= 64
        assert all(r.padded_length == (end if end & (end - 1) == 0 else 64) for r in pieces)
    assert sorted(windows) == list(range(len(windows)))


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], DOCS), PATH).collect() == []
    assert [r.length for r in pack(documents(spark, [(1, None, None, None)]), PATH).collect()] == [1]
