"""Tokenizer operators against their libraries, collocations against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ratewise.llm import alignment, bpe, collocations
from ratewise.llm.queries import LLM_QUERIES

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(BYTE_BPE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


# ---- encoding and decoding ----------------------------------------------------


def same_as_library(texts, vocabulary, library, specials=True):
    library.encode_special_tokens = not specials
    ids, bounds = bpe.Encoder(vocabulary, specials).encode([t.encode() for t in texts])
    decoded = bpe.Decoder(vocabulary.token_bytes).decode(ids, bounds)
    for i, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[bounds[i] : bounds[i + 1]].tolist() == want, text[:80]
        assert decoded[i].decode() == library.decode(want, skip_special_tokens=False)


EDGES = [
    "", " ", "   ", "\n", " \n ", "it's we'll 's 'strong 'S don't'd''s", "\n's  's\t'm'", "'", "a'", "''r",
    "q  ", "x　　y   z\t\n", "123abc½Ⅷ 世界!?..", "a" * 5000, "h́e \U0001f600",
    "<|endoftext|>a <|endoftext|>  <|endoftext|>", "<|endoftext|", "\x1c\x85 ",
]


@pytest.mark.parametrize("specials", [True, False])
def test_ids_of_edge_cases(vocabulary, library, specials):
    same_as_library(EDGES, vocabulary, library, specials)


def test_ids_of_random_texts(vocabulary, library):
    random.seed(3)
    parts = ["a", "b", " ", "  ", "'s", "'re", "'", "\n", "\t", "1", "!", "é", "世", "<|endoftext|>", "　"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 30))) for _ in range(3000)]
    same_as_library(texts, vocabulary, library)


def test_class_of_every_character(vocabulary, library):
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x32000), *range(0xE0000, 0xE0200)]))
    same_as_library([every[i : i + 4000] for i in range(0, len(every), 4000)], vocabulary, library)


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_ids_of_any_text(vocabulary, library, texts):
    same_as_library(texts, vocabulary, library)


@settings(max_examples=100, deadline=None)
@given(ids=st.lists(st.integers(0, 50400), max_size=12))
def test_texts_of_any_ids(vocabulary, library, ids):
    got = bpe.Decoder(vocabulary.token_bytes).decode(np.array(ids), np.array([0, len(ids)]))[0]
    assert got.decode() == library.decode(ids, skip_special_tokens=False)


def test_both_ways_of_joining_agree(vocabulary):
    random.seed(5)
    words = [bytes(random.choice(b"theanoris ") for _ in range(random.randint(1, bpe.SHORT))) for _ in range(500)]
    ids, count = bpe.join_short(words, vocabulary)
    ends = np.cumsum(count)
    for word, a, b in zip(words, ends - count, ends, strict=True):
        assert ids[a:b].tolist() == bpe.join_long(word, vocabulary).tolist()


def test_a_full_cache_is_emptied(vocabulary):
    small, large = bpe.Encoder(vocabulary, cached=3), bpe.Encoder(vocabulary)
    for texts in ([b"one two three four five"], [b"two three", b"six seven"], [b""]):
        (a, x), (b, y) = small.encode(texts), large.encode(texts)
        assert a.tolist() == b.tolist() and x.tolist() == y.tolist()


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_registered_encoding(spark, sf, library):
    library.encode_special_tokens = False
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = LLM_QUERIES["op13_rank_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_encoding_of_odd_rows(spark, odd, none, vocabulary):
    clash = odd.withColumn("IDS", F.lit("mine"))
    got = bpe.encode(clash, vocabulary)
    assert got.columns == [*odd.columns, "ids"]
    back = bpe.decode(got, vocabulary, to="back")
    assert back.filter("back <> coalesce(text, '')").count() == 0 and back.count() == odd.count()
    assert got.filter("text is null and size(ids) > 0").count() == 0
    whole = bpe.decode(got, vocabulary, to="Text")
    assert whole.columns == ["doc_id", "lang", "source", "n_chars", "n_docs", "ids", "Text"]
    assert bpe.decode(bpe.encode(none, vocabulary), vocabulary).count() == 0
    lists = spark.createDataFrame([(None,), ([],), ([None, 64, -1, 10**9],)], "ids array<int>")
    assert sorted(r.text for r in bpe.decode(lists, vocabulary).collect()) == ["", "", "a"]


# ---- alignment ----------------------------------------------------------------


def brute_alignment(texts):
    """By doc: both id lists, groups and links, by comparing all pairs of byte ranges."""
    a_lib, b_lib = Tokenizer.from_file(BYTE_BPE), SentencePieceProcessor(model_file=PIECE_BPE)
    a_lib.encode_special_tokens = True
    byte_of = bpe.printable_bytes()

    def a_bytes(i):
        return bytes(byte_of[c] for c in a_lib.id_to_token(i))

    def b_bytes(i):
        p = b_lib.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()

    def ranges(ids, of):
        end, out = 0, []
        for i in ids:
            out.append((i, end, end + len(of(i))))
            end = out[-1][2]
        return out

    found = {}
    for key, text in texts.items():
        a, b = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids, b_lib.encode(text or "")
        same = all(b"".join(map(f, x)) == (" " + (text or "")).encode() for f, x in ((a_bytes, a), (b_bytes, b)))
        if not text or not same:
            found[key] = ([], [], [], [])
            continue
        ra, rb = ranges(a, a_bytes), ranges(b, b_bytes)
        common = sorted({e for *_, e in ra} & {e for *_, e in rb})
        groups = [
            ([i for i, s, e in ra if x <= s and e <= y], [i for i, s, e in rb if x <= s and e <= y])
            for x, y in zip([0, *common], common, strict=False)
        ]
        links = [(i, j) for i, s, e in ra for j, t, f in rb if max(s, t) < min(e, f)]
        found[key] = (a, b, groups, links)
    return found


def expected_alignment(texts):
    found = brute_alignment(texts)
    count = Counter(x for *_, links in found.values() for x in links)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = {}
    for key, (a, b, groups, links) in found.items():
        text = ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)
        best = sum(count[x] == most[x[1]] for x in links)
        out[key] = (
            len(a), len(b), len(groups), len(links), best, sum(count[x] for x in links),
            sha(text) if text else "",
        )
    return out


def test_registered_alignment(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy(F.length("text")).limit(120)
    extra = [(-1, None), (-2, ""), (-3, "a ▁ b"), (-4, "<s></s><|endoftext|>"), (-5, "\n\t  x"), (-6, " lead")]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id bigint, text string"))
    both.write.parquet(f"{tmp_path}/documents.parquet")
    want = expected_alignment({r.doc_id: r.text for r in both.collect()})
    assert want[-1] == want[-2] == want[-3] == (0, 0, 0, 0, 0, 0, "")
    assert want[-4][0] > 0 and want[-5][0] > 0
    rows = LLM_QUERIES["op11_token_alignment"](spark, str(tmp_path)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == want


def test_alignment_over_several_parts(spark, sf, monkeypatch):
    """The same counts however many documents share a list of pairs."""
    a = alignment.read_tokenizer(BYTE_BPE)
    b = alignment.read_tokenizer(PIECE_BPE)
    monkeypatch.setattr(alignment, "PART_BYTES", 50_000)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    one = alignment.align_and_count(docs.coalesce(1), a, b).collect()
    many = alignment.align_and_count(docs.repartition(7), a, b)
    assert {tuple(r) for r in one} == {tuple(r) for r in many.collect()}
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_stretches_give_what_whole_texts_give(spark, sf):
    whole = alignment.Aligner(*(alignment.read_tokenizer(f) for f in (BYTE_BPE, PIECE_BPE)))
    parts = alignment.Aligner(*(alignment.read_tokenizer(f) for f in (BYTE_BPE, PIECE_BPE)))
    assert whole.a.apart and whole.b.apart
    whole.a.apart = False
    a_lib, b_lib = Tokenizer.from_file(BYTE_BPE), SentencePieceProcessor(model_file=PIECE_BPE)
    a_lib.encode_special_tokens = True
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += ["a\n  b c　 d e  f \x85 g é  h! 's x ", "a ▁ b", "", "  ", "\t x", "<s> </s> <|endoftext|>", "x", " x", "x "]
    data = [t.encode() for t in texts]
    x, y = whole.align(data), parts.align(data)
    assert x.groups == y.groups and (x.counts == y.counts).all()
    assert (x.pairs == y.pairs).all() and (x.bounds == y.bounds).all()
    for t, n in zip(texts, y.counts, strict=True):
        if t and "▁" not in t:
            own = len(a_lib.encode(" " + t, add_special_tokens=False).ids), len(b_lib.encode(t))
            assert tuple(n[:2]) == own, t[:50]


def test_alignment_of_odd_rows(spark, odd, none):
    a = alignment.read_tokenizer(BYTE_BPE)
    b = alignment.read_tokenizer(PIECE_BPE)
    clash = odd.withColumn("_n_a", F.lit("mine"))
    got = alignment.align_and_count(clash, a, b)
    rows = got.collect()
    assert len(rows) == odd.count() and {r._n_a for r in rows} == {"mine"}
    assert got.columns[: len(clash.columns)] == clash.columns
    assert all(r["__n_links"] == r["__n_a"] + r["__n_b"] - r["__n_groups"] for r in rows)
    assert all(r["__n_a"] == 0 for r in rows if not r.text)
    assert alignment.align_and_count(none, a, b).count() == 0


# ---- collocations -------------------------------------------------------------


def brute_collocations(rows, top=2000, min_count=10):
    total, f = Counter(), defaultdict(Counter)
    for label, text in rows:
        label = label or "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            w = re.findall("[^ \t]+", piece)
            total[label] += len(w)
            for k in (1, 2, 3):
                f[label].update(zip(*(w[i:] for i in range(k)), strict=False))
    out = set()
    for label, c in f.items():
        wanted = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        inside = Counter()
        for p, a in wanted.items():
            for q in (p[:2], p[1:]) if len(p) == 3 else ():
                inside[q] = max(inside[q], a)
        kept = []
        for p, a in wanted.items():
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            if 100 * inside[p] < 50 * a:
                kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.add((label, i, p.decode(), -a, left, right, total[label], -s))
    return out


COLUMNS = ["label", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_collocations(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [(r.lang, r.text) for r in docs.collect()]
    made = [(None, "A b c. " * 12 + "a B\tc d, d\nd d d d d d d d d d d d"), ("xx", "p q r;" * 10 + "q r q r")]
    both = spark.createDataFrame([*texts, *made], "lang string, text string")
    # A shard of 40 phrases: the tries of many shards give the same.
    got = {tuple(r) for r in collocations.collocations(both, shard=40).select(COLUMNS).collect()}
    assert got == brute_collocations([*texts, *made])
    labels = {g[0] for g in got}
    assert "und" in labels and "xx" in labels


def test_collocations_keep_the_first_of_each_label(spark):
    rows = [("x", " ".join(f"w{i} v{i}" for i in range(30)) + ".") for _ in range(12)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(docs, top=5).select(COLUMNS).collect()
    assert {tuple(r) for r in got} == brute_collocations(rows, top=5)


def test_scores_need_more_than_64_bits(spark):
    rows = [("x", "p", 1, 4 * 10**12), ("x", "q", 1, 3 * 10**12), ("x", "p q", 2, 2 * 10**12)]
    phrases = spark.createDataFrame(rows, "label string, phrase string, size int, n bigint")
    assert collocations.scored(phrases).first().score == 10**6 * 4 // 12


def test_trie_and_sieve_hold_all_and_only_theirs():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 2**64, 400, dtype=np.uint64)
    rows = words[rng.zipf(1.3, (5000, 3)) % 400]
    rows = np.unique(rows, axis=0)
    rng.shuffle(rows)
    trie = collocations.build_trie(rows)

    def walk(rows):
        state = np.zeros(len(rows), np.int32)
        for k in range(3):
            state = trie.step(state, trie.codes(rows[:, k]))
        return np.where(state >= 0, trie.key[state], -1)

    assert walk(rows).tolist() == list(range(len(rows)))
    held = {tuple(r) for r in rows.tolist()}
    other = words[rng.integers(0, 400, (50_000, 3))]
    assert ((walk(other) >= 0) == [tuple(r) in held for r in other.tolist()]).all()
    sieve = collocations.Sieve(np.zeros(collocations.Sieve.size(400) // 8, np.uint8))
    sieve.add(words)
    assert sieve.has(words).all()
    assert sieve.has(rng.integers(0, 2**64, 10_000, dtype=np.uint64)).mean() < 0.1


def test_sieve_grows_with_its_keys_up_to_a_bound():
    sizes = [collocations.Sieve.size(10**k) for k in range(10)]
    assert sizes == sorted(sizes) and sizes[-1] == collocations.SIEVE_BITS
    assert sizes[6] >= 16 * 10**6


def test_collocations_of_odd_rows(spark, odd, none):
    got = collocations.collocations(odd).select(COLUMNS).collect()
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert {tuple(r) for r in got} == brute_collocations(rows)
    assert collocations.collocations(none).count() == 0


def test_each_word_of_a_block_is_hashed_once(spark):
    texts, labels = [b"a b a, b a", b"", b"a c"], ["en", "en", "de"]
    block = collocations.block_of_texts(texts, labels)
    at, keys = collocations._safe(block, 1, None)
    assert at.tolist() == [0, 1, 5, 6] and len(set(keys.tolist())) == 4
    assert (keys[block.code] == block.keys(np.arange(7), 1)).all()
    assert (collocations._safe(block, 2, None)[0] == [0, 1, 3, 5]).all()
    rows = np.column_stack([block.label_hash, block.word_hash])
    assert collocations.build_trie(rows).accepted(block, 1).tolist() == [3, 2, 1, 1]
    # A block's words come back from a row as they were; a block of no words is none.
    docs = spark.createDataFrame([("é a é", "x"), ("", "y")], "text string, label string").coalesce(1)
    rows = collocations._text_blocks(docs).toArrow()
    (again,) = collocations._read(rows.to_batches())
    assert again.word.to_pylist() == ["é", "a"] and again.code.tolist() == [0, 1, 0]
    nothing = collocations._text_blocks(docs.filter("text = ''")).toArrow()
    assert list(collocations._read(nothing.to_batches())) == []


def test_candidates_of_the_first_blocks_are_not_given_again(spark, monkeypatch):
    rows = [(f"one two three four five {'ab'[i % 2]} x{i} .", "en") for i in range(200)]
    texts = spark.createDataFrame(rows, "text string, label string")
    blocks = collocations._text_blocks(texts.select("label", "text"))
    bounds = collocations._upper_bounds(blocks, 2, None, 20, 1400, 10)
    held = collocations.sieve_of(bounds)
    every = collocations._given(blocks, 2, None, held, 20)
    keys = {r.key for r in every.collect()}
    assert len(keys) == 6
    assert collocations._given(blocks, 2, None, held, 20, collocations._known(every, 100)).isEmpty()
    few = collocations._known(every, 2)
    again = {r.key for r in collocations._given(blocks, 2, None, held, 20, few).collect()}
    assert len(again) == 4 and again < keys
    # A list that is too short costs rows, never a phrase.
    monkeypatch.setattr(collocations, "_BLOCK_BYTES", 200)
    want = sorted(map(tuple, collocations.collocations(texts, "label", "text").collect()))
    monkeypatch.setattr(collocations, "KNOWN", 2)
    monkeypatch.setattr(collocations, "_WAVES", 3)
    assert sorted(map(tuple, collocations.collocations(texts, "label", "text").collect())) == want != []


def test_shards_of_candidates_need_no_pass_of_their_own(spark, monkeypatch):
    rows = [(f"one two three four five {'ab'[i % 2]} x{i % 9} . y{i}", "ab"[i % 3 == 0]) for i in range(300)]
    texts = spark.createDataFrame(rows, "text string, label string").repartition(5)
    written, write = [], collocations._written
    monkeypatch.setattr(collocations, "_written", lambda df, name, *rows: written.append(name) or write(df, name, *rows))

    def found(shard):
        written.clear()
        _, phrases = collocations.frequent_phrases(texts, shard=shard)
        return sorted(map(tuple, phrases.collect())), len(written)

    want, few = found(1 << 17)
    assert {(r[2], r[3]) for r in want} >= {(1, 200), (3, 100)} and len(want) > 40
    # A trie of two phrases: many shards, as many passes over the blocks.
    assert found(2) == (want, few)
    # Blocks of a text or two, and tasks that send their sequences at once.
    monkeypatch.setattr(collocations, "_BLOCK_BYTES", 60)
    monkeypatch.setattr(collocations, "SENT", 5)
    assert found(3) == (want, few)


def test_tries_count_sequences_as_often_as_they_say():
    rng = np.random.default_rng(5)
    symbols = rng.integers(0, 2**64, 50, dtype=np.uint64)
    places = np.unique(rng.integers(0, 40, (300, 3)), axis=0)
    trie = collocations.build_trie(symbols[places])
    met = np.concatenate([places, rng.integers(0, 50, (400, 3))])
    times = rng.integers(1, 2**31, len(met))
    want = Counter()
    for row, n in zip(met.tolist(), times.tolist(), strict=True):
        want[tuple(row)] += n
    got = trie.counted(symbols, list(met.T), times)
    assert got.tolist() == [want[tuple(p)] for p in places.tolist()]
    one = trie.counted(symbols, list(met.T))
    assert one.tolist() == [(met == p).all(axis=1).sum() for p in places]


def test_numbers_of_a_block_come_back_in_any_width():
    for most, width in ((0, 1), (255, 1), (256, 2), (65_536, 3), (2**31 - 1, 4), (2**40, 6)):
        numbers = np.array([0, most // 2, most])
        small = collocations._small(numbers)
        assert len(small) == 1 + 3 * width
        assert collocations._numbers(pa.scalar(small, pa.binary())).tolist() == numbers.tolist()
    assert collocations._numbers(pa.scalar(collocations._small(numbers[:0]), pa.binary())).tolist() == []
