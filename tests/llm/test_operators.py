"""The operators against brute force, and on odd, empty and repeated rows."""

import collections
import gzip
import hashlib
import re
import time
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ratewise.llm import (
    components,
    decontamination,
    maxent,
    mixing,
    perplexity,
    queries,
    repeats,
    rollups,
    simhash,
    templates,
    toxicity,
    warc,
)
from ratewise.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def lower(text):
    return text.encode().lower().decode()


# ---- 1: language model ----------------------------------------------------------


def test_base_scores_and_counts(spark, sf, texts):
    got = entry.queries()["op1_hashed_maxent"](spark, sf).toPandas()
    words = {i: WORD.findall(lower(t)) + [None] for i, t in texts.items()}
    counts = collections.Counter()
    for i, w in words.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(texts)
    for r in got.itertuples():
        w = words[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in w))
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_model_probabilities_add_up():
    """Over all known tokens and one unknown, after any history."""
    shape = maxent.Shape(slots=4, head_classes=2, bits=6)
    train = [b"a b c d e f g h i j a b a c long-words of some kind a b", b"a a b"]
    t = maxent.tokens(train, shape)
    token, first, n = np.unique(t.hashes, return_index=True, return_counts=True)
    order = np.lexsort((token, -n))
    top, rest = order[: shape.head], order[shape.head :]
    counts = np.zeros(shape.head)
    counts[: len(top)] = n[top]
    tail = np.zeros((2, shape.tail_classes))
    np.add.at(tail[0], t.surface[first][rest], n[rest])
    np.add.at(tail[1], t.surface[first][rest], 1)
    head = counts.reshape(2, 4)
    share = np.concatenate([head.sum(axis=1), tail[0]]) + 0.5
    by_hash = np.argsort(token[top])
    model = maxent.Model(
        shape, token[top][by_hash], by_hash, counts, tail[0], tail[1],
        np.full(shape.tail_classes, 0.4), np.log(share / share.sum()).astype(np.float32),
        np.log(np.maximum(head, 1)).astype(np.float32),
    )
    model.empty_weights()
    seen = np.zeros(64, np.float32)
    maxent.learn(model, train, seen, seen.copy())
    rows = [r[5:6] for r in maxent._rows(t, shape)]
    p = maxent._softmax(maxent._class_scores(model, rows))[0]
    assert p.sum() == pytest.approx(1, abs=1e-5)
    inside = np.zeros(shape.classes)
    c = np.arange(2)
    q = maxent._softmax(model.slot_bias[c] + model.slot_weights[model.slot_rows(rows, c)])
    inside[:2] = q.sum(axis=1)
    for k in range(shape.tail_classes):
        cls = np.array([2 + k])
        own = n[rest][t.surface[first][rest] == k]
        inside[2 + k] = sum(np.exp(model.tail_log(cls, np.array([x])))[0] for x in (*own, 0))
    assert inside == pytest.approx(np.ones(shape.classes), abs=1e-5)


def test_history_of_three_tokens_and_rounds_that_build_on_each_other(spark, monkeypatch):
    shape = maxent.Shape()
    one, other = (maxent._rows(maxent.tokens([t], shape), shape) for t in (b"a x y z", b"b x y z"))
    assert sum(r[3] != o[3] for r, o in zip(one, other)) == 1
    assert shape.head == 1024
    starts, of = [], maxent.train_round

    def seen(docs, shared, *rest):
        starts.append(shared.value.weights.any())
        return of(docs, shared, *rest)

    monkeypatch.setattr(maxent, "train_round", seen)
    docs = spark.createDataFrame([(i, f"some words of {i}") for i in range(40)], "doc_id bigint, text string")
    maxent.score(docs, F.lit(False)).count()
    assert starts[:2] == [False, True]


# ---- 2: mixing -----------------------------------------------------------------


def test_raking_meets_targets_and_bounds():
    cells = {(s, g, t): 100.0 * (i + 1) for i, (s, g, t) in enumerate(
        (s, g, t) for s in ("a", "other") for g in ("x", "y") for t in ("p", "q"))}
    targets = mixing.Targets({"a": 0.5, "other": 0.5}, {"x": 0.6, "y": 0.4}, {"p": 0.5, "q": 0.5})
    p = mixing.rake(cells, targets, 0.3)
    total = sum(p[c] * n for c, n in cells.items())
    assert total == pytest.approx(0.3 * sum(cells.values()))
    for k, margin in enumerate(targets.margins().values()):
        for name, share in margin.items():
            assert sum(p[c] * n for c, n in cells.items() if c[k] == name) == pytest.approx(share * total)
    assert max(mixing.rake(cells, targets, 0.9).values()) <= 1
    assert mixing.rake({}, targets, 0.5) == {}


def test_targets_out_of_reach_are_approached_and_told():
    cells = {("a", "x", "p"): 10.0, ("other", "x", "p"): 60.0, ("other", "y", "p"): 30.0}
    targets = mixing.Targets({"a": 0.5, "other": 0.5}, {"x": 0.6, "y": 0.4})
    met = mixing.calibrate(cells, targets, 0.1)
    assert met.met and met.tokens == pytest.approx(10, rel=1e-3)
    with pytest.warns(mixing.OutOfReach, match="source a: 0.1"):
        far = mixing.calibrate(cells, targets, 0.8)
    assert 0 < far.strength < 1 and not far.met and far.error <= mixing.MET
    assert far.tokens == pytest.approx(80, rel=1e-3)
    share = {m.category: m for m in far.margins if m.margin == "source"}
    # All of the scarce source is taken, which is more than its share of the data.
    assert far.probability["a", "x", "p"] > 0.99 and share["a"].held < share["a"].expected < 0.5
    assert share["a"].expected == pytest.approx(10 / 80, rel=0.01)
    with pytest.raises(mixing.OutOfReach):
        mixing.calibrate(cells, targets, 0.8, strict=True)
    with pytest.warns(mixing.OutOfReach, match="lang z"):
        mixing.calibrate(cells, mixing.Targets(lang={"x": 0.5, "y": 0.3, "z": 0.2}), 0.1)
    assert mixing.calibrate({}, targets, 0.5).probability == {}


def test_margins_of_the_query(spark, sf):
    """Its expected tokens are half of all, and each share lies between the held and the wanted."""
    with pytest.warns(mixing.OutOfReach):
        got = queries.op2_raking(spark, sf).toPandas()
    n, drawn = got.n_tokens, got.n_tokens * got.probability
    assert drawn.sum() == pytest.approx(0.5 * n.sum(), rel=2e-4)
    for column, listed in (
        ("source_cell", queries.MIXTURE.source),
        ("lang_cell", queries.MIXTURE.lang),
        ("topic_cell", queries.MIXTURE.topic),
    ):
        held = n.groupby(got[column]).sum() / n.sum()
        reached = drawn.groupby(got[column]).sum() / drawn.sum()
        total = sum(listed.values())
        for name, wanted in listed.items():
            low, high = sorted((held[name], wanted / total))
            assert low - 0.01 < reached[name] < high + 0.01, (name, held[name], reached[name], wanted)
        off = lambda s: sum(abs(s[c] - w / total) for c, w in listed.items())
        assert off(reached) < off(held) + 0.01


def test_draws_follow_probabilities(spark, sf):
    got = queries.op2_raking(spark, sf).toPandas()
    again = queries.op2_raking(spark, sf).toPandas()
    assert got.sort_values("doc_id").sampled.tolist() == again.sort_values("doc_id").sampled.tolist()
    assert abs(got.sampled.sum() - got.probability.sum()) < 4 * len(got) ** 0.5
    assert got[got.probability >= 1].sampled.all()


def test_unlisted_categories_keep_their_share(spark):
    langs = ["en", "de", "fr", "es", "en", "de", None, "ru", "", "other"]
    rows = [(i, f"text {i} " + "word " * 50, langs[i % 10], f"src{i % 3}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = mixing.mix(docs, queries.MIXTURE, 0.5).collect()
    rest = [r for r in got if r.lang not in ("en", "de", "fr", "es")]
    assert all(r._weight is not None for r in got)
    assert {r.lang for r in rest if r._sampled} == {None, "ru", "", "other"}
    expected = sum(r._tokens * r._probability for r in got)
    assert sum(r._tokens * r._probability for r in rest) == pytest.approx(0.4 * expected)
    en = sum(r._tokens * r._probability for r in got if r.lang == "en")
    assert en == pytest.approx(0.55 * 0.6 * expected, rel=1e-3)
    cells = {("a", "x", "p"): 60.0, ("other", "x", "p"): 40.0}
    p = mixing.rake(cells, mixing.Targets({"a": 1.0}), 0.5)
    assert p == pytest.approx({c: 0.5 for c in cells})


# ---- 3: line templates -----------------------------------------------------------


def test_templates_generalise_and_keep_the_first(spark):
    rows = [(i, f"Order {i} for name{chr(97 + i)} was shipped on day {i}\n{chr(97 + i) * 4} text of its own")
            for i in range(8)]
    rows += [(20 + i, f"User logged {w} from {v} at noon today again\nother {w} line {v} alone")
             for i, (w, v) in enumerate(zip("abcdefgh", "stuvwxyz"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in templates.drop_recurring(docs, min_docs=5, depth=2).collect()}
    assert got[0] == rows[0][1] and got[20] == rows[8][1]
    assert all(got[i] == rows[i][1].split("\n")[1] for i in range(1, 8))
    assert all(got[20 + i].startswith("other") for i in range(1, 8))


def test_third_token_varies_by_default(spark):
    import corpus_pipeline as pipeline

    rows = [(20 + i, f"User logged {w} from {v} at noon today again\nother {w} line {v} alone")
            for i, (w, v) in enumerate(zip("abcdefgh", "stuvwxyz"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for kept in (templates.drop_recurring(docs), pipeline.drop_recurring_lines(spark, docs, "")):
        got = {r.doc_id: r.text for r in kept.collect()}
        assert got[20] == rows[0][1]
        assert all(got[20 + i].startswith("other") for i in range(1, 8))


@pytest.mark.parametrize("parts", [(40, 35, 25), (60, 40)])
def test_several_templates_of_a_leaf(spark, parts):
    lines = ["of {} cats sat down by the old door", "of {} dogs ran over to their new home",
             "of {} birds flew far from all warm trees"]
    rows = [(100 * k + i, f"Here {lines[k].format(f'w{chr(97 + i % 26)}{chr(97 + i // 26)}')}\nown {k}x")
            for k, n in enumerate(parts) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id for r in templates.drop_recurring(docs).collect() if r.text.startswith("Here")}
    assert kept == {100 * k for k in range(len(parts))}


def brute_templates(texts, depth=2, min_docs=5, min_tokens=3, similarity=0.5):
    """Kept text and number of dropped lines by document: the rounds, group by group."""
    holders, places = collections.defaultdict(set), []
    for doc, text in texts.items():
        for no, line in enumerate(text.split("\n") if text is not None else []):
            tokens = tuple(
                "<*>" if re.search("[0-9]", t) else t for t in re.split(r"[ \t\x0b\f\r]+", line) if t)
            if len(tokens) >= max(min_tokens, depth):
                holders[tokens].add(doc)
                places.append((tokens, doc, no))
    leaves = collections.defaultdict(list)
    for tokens in holders:
        leaves[len(tokens), tokens[:depth]].append(tokens)
    general = {}
    todo = [(leaf, [t for t in found if len(t) > depth]) for leaf, found in leaves.items() if len(found) > 1]
    while todo:
        name, group = todo.pop()
        n = {t: len(holders[t]) for t in group}
        total = sum(n.values())
        votes = collections.defaultdict(collections.Counter)
        for t in group:
            for place, token in enumerate(t[depth:]):
                votes[place][token] += n[t]
        if total < min_docs:
            continue
        best = [max((c, t.encode(), t) for t, c in votes[p].items()) for p in sorted(votes)]
        if sum(2 * c > min_docs for c, _, _ in best) < similarity * len(best):
            continue
        constants = tuple(t if 2 * c > total else None for c, _, t in best)
        split = [(c, -p) for p, (c, _, _) in enumerate(best) if 2 * c <= total and c >= min_docs]
        place = -max(split)[1] if split else None
        follows = [t for t in group
                   if sum(a == b for a, b in zip(t[depth:], constants)) >= similarity * len(constants)]
        held = sum(n[t] for t in follows)
        if held >= min_docs and (4 * held >= total or place is None):
            general |= {t: (name, constants) for t in follows}
            todo.append(((name, "others"), [t for t in group if t not in set(follows)]))
        elif place is not None:
            parts = collections.defaultdict(list)
            for t in group:
                token = t[depth + place]
                parts[token if votes[place][token] >= min_docs else None].append(t)
            todo += [((name, place, token), part) for token, part in parts.items()]
    members = collections.defaultdict(lambda: collections.defaultdict(list))
    for tokens, doc, no in places:
        members[general.get(tokens, tokens)][doc].append(no)
    drop = collections.defaultdict(set)
    for docs in members.values():
        if len(docs) >= min_docs:
            first = min(docs)
            for doc, found in docs.items():
                drop[doc] |= set(found) - ({min(found)} if doc == first else set())
    return {
        doc: (None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop[doc]),
              len(drop[doc]))
        for doc, text in texts.items()
    }


def test_registered_templates_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op3_line_templates(spark, sf).toPandas()
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = brute_templates({r.doc_id: r.text for r in rows})
    assert len(got) == len(want) and got.n_dropped.sum() > 100
    for r in got.itertuples():
        text, dropped = want[r.doc_id]
        digest = hashlib.sha256(text.encode()).hexdigest() if text is not None else None
        assert (r.n_dropped, r.kept_sha256) == (dropped, digest), r.doc_id


def test_votes_and_lines_that_cannot_recur_are_not_moved(spark, monkeypatch):
    paths = collections.defaultdict(list)

    def noted(session, name):
        paths[name].append(scratch_path(session, name))
        return paths[name][-1]

    monkeypatch.setattr(templates, "scratch_path", noted)
    rows = [(i, f"Here of w{chr(97 + i)} cats sat down by the old door\nown {chr(97 + i)}x line\nall have this")
            for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id: r.text for r in templates.drop_recurring(docs).collect()}
    assert kept == {i: t if i == 0 else t.split("\n")[1] for i, t in rows}
    votes = spark.read.parquet(*paths["line-votes"]).filter("n * 2 <= 5")
    assert votes.count() == 0
    # The eight lines of the template, and the one that all documents have.
    assert spark.read.parquet(*paths["named-lines"]).count() == 9


def test_few_documents_keep_their_lines(spark):
    docs = spark.createDataFrame([(i, "a line that is shared\nb") for i in range(4)], "doc_id bigint, text string")
    assert {r.text for r in templates.drop_recurring(docs).collect()} == {"a line that is shared\nb"}


# ---- 4: decontamination -----------------------------------------------------------


def brute_contamination(docs, items):
    rx = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    known = {}
    for i, t in items:
        w = rx.findall(lower(t or ""))
        n = min(13, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            known.setdefault(tuple(w[s : s + n]), set()).add(str(i))
    out = []
    for t in docs:
        w, hit, found = rx.findall(lower(t or "")), set(), set()
        for n in {len(k) for k in known}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in known:
                    hit |= set(range(s, s + n))
                    found |= known[tuple(w[s : s + n])]
        out.append((len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_hits_of_long_and_short_items(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(40)]

    def prose(n):
        return [str(x) for x in rng.choice(vocabulary, n)]

    items = [(1, prose(30)), (2, prose(13)), (3, ["short", "Item"]), (4, ["tiny"]), (5, []), (6, prose(20))]
    docs = [prose(200) + items[0][1][4:20] + prose(9), prose(5) + items[1][1], prose(80),
            ["A", "short", "item", "is"] + prose(30), items[0][1] + items[5][1], ["a"] * 50, []]
    items = [(i, " ".join(w)) for i, w in items] + [(7, None), (8, " ".join(items[0][1]))]
    texts = [" ".join(w).title() for w in docs]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted(decontamination.contamination(d, b).collect())
    want = brute_contamination(texts, items)
    assert [(r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got] == want
    assert {r.doc_id for r in decontamination.clean(d, b).collect()} == {
        i for i, w in enumerate(want) if not w[3]}


# ---- 5: quality ---------------------------------------------------------------------


def test_rule_counts(spark, sf, texts):
    got = queries.op5_kneser_ney(spark, sf).toPandas()
    for r in got.itertuples():
        t = texts[r.doc_id]
        w, seen, same = WORD.findall(t), set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                same += line in seen
                seen.add(line)
        runs = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        again = {j for i in range(len(w) - 7) if runs[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        marks = len(re.findall(r"[#*$%&|<>]", t))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), marks, same, len(again))
        assert r.base_failed == (len(w) < 20 or 100 * len(again) > 30 * len(w))
        assert not (r.kept and r.base_failed)
    assert (got.kept != ~got.base_failed).any()


def test_bands_tell_junk_from_good_texts(spark):
    """Of labelled texts that pass the base rules: what the band adds."""
    sf = "/root/testdata/sf0.1"
    got = queries.op5_kneser_ney(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    passed = got[~got.base_failed].merge(labels, on="doc_id")
    kept = passed.groupby("quality").kept.mean()
    assert kept[0] < 0.4 and kept[1] > 0.98, kept


def test_letters_of_every_script_count(spark):
    """Among Cyrillic texts, the same letters shuffled or in another script are rejected."""
    rng = np.random.default_rng(2)
    words = ["слово", "дорога", "молоко", "вечером", "читает", "книга", "город", "светлый", "и", "на"]
    texts = [" ".join(rng.choice(words, 120)) for _ in range(60)]
    mixed = ["".join(rng.permutation(list(texts[0]))), "".join(
        chr(0x4E00 + ord(c) * 7 % 5000) if c.isalpha() else c for c in texts[1])]
    rows = [(i, t, "ru") for i, t in enumerate([*texts, *mixed])]
    got = perplexity.assess(spark.createDataFrame(rows, "doc_id int, text string, lang string")).collect()
    kept = {r.doc_id: r.kept for r in got}
    assert sum(kept[i] for i in range(60)) >= 58 and not kept[60] and not kept[61]


def test_every_language_has_a_model_in_any_number_of_waves(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(240):
        lang = i % 12
        letters = [chr(97 + (lang * 2 + k) % 26) for k in range(4)]
        rows.append((i, " ".join("".join(rng.choice(letters, 5)) for _ in range(60)),
                     None if lang == 11 else f"l{lang}"))
    rows += [(240, rows[0][1], "l1"), (241, None, "only null"), (242, "", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")

    def assessed():
        return sorted(perplexity.assess(docs).collect(), key=lambda r: r.doc_id)

    once = assessed()
    assert [r.doc_id for r in once] == list(range(243))
    assert len({r.model for r in once}) == 13
    monkeypatch.setattr(perplexity, "WAVE_ROWS", 1)
    assert len(perplexity.waves({"a": 5, "b": 5})) == 2
    assert assessed() == once
    kept = {r.doc_id: r.kept for r in once}
    assert sum(kept[i] for i in range(240)) > 200 and not kept[241]
    # A text of another language is the least likely one under this language's own model.
    score = {r.doc_id: r.log_perplexity for r in once if r.model == "l1"}
    assert score.pop(240) > max(score.values())
    assert perplexity.waves({"a": 5, "b": 5, "c": 1}, 6) == [["a"], ["b", "c"]]


def test_kneser_ney_adds_up_and_backs_off():
    rng = np.random.default_rng(0)
    gram = np.unique(rng.integers(0, 32**4, 3000))
    arrays = {}
    for kind, g, value in perplexity.fit_model(gram, rng.integers(1, 9, len(gram))):
        h = perplexity.gram_hash(g, kind if kind > 0 else 8 - kind)
        order = np.argsort(h)
        arrays[kind] = (h[order], value[order].astype(np.float32))
    every = np.arange(perplexity.SYMBOLS**perplexity.ORDER, dtype=np.uint32)
    p = 10.0 ** perplexity.Model(arrays).of_texts(every).astype(float)
    assert p.reshape(-1, 32).sum(axis=1) == pytest.approx(np.ones(32**3), abs=1e-4)


def test_every_letter_has_its_own_symbol():
    letters = [chr(c) for c in range(0x250, 0x3000) if chr(c).isalpha() and chr(c).lower() == chr(c)]
    letters = [c for c in [*letters, *"æøßđłœþħ", *"漢字語中"] if not "a" <= unicodedata.normalize("NFD", c)[0] <= "z"]
    assert len({perplexity.symbol_of(ord(c)) for c in letters}) == len(set(letters))


def test_steps_are_added_by_row_in_less_time_than_by_cell():
    rng = np.random.default_rng(8)
    rows = [rng.zipf(1.5, 2048) % 16384 for _ in range(4)]
    steps = rng.standard_normal((2048, 56)).astype(np.float32)

    def by_cell(table, seen):
        at, place = np.unique(np.concatenate(rows), return_inverse=True)
        cells = (place[:, None] * 56 + np.arange(56)).ravel()
        total = np.bincount(cells, np.tile(steps.ravel(), 4), len(at) * 56).reshape(-1, 56)
        times = np.bincount(place)
        seen[at] += times
        table[at] -= total / np.sqrt(times * seen[at])[:, None]

    found = {}
    for add in (by_cell, lambda table, seen: maxent._add(table, rows, steps, seen)):
        table, seen, least = np.zeros((16384, 56), np.float32), np.zeros(16384, np.float32), 9.0
        for _ in range(9):
            began = time.process_time()
            add(table, seen)
            least = min(least, time.process_time() - began)
        found[add] = table, seen, least
    (want, want_seen, before), (got, got_seen, after) = found.values()
    assert np.array_equal(got_seen, want_seen) and np.allclose(got, want, rtol=1e-6, atol=1e-7)
    assert after < 0.75 * before
    table, seen = np.zeros((1 << 17, 3), np.float32), np.zeros(1 << 17, np.float32)
    maxent._add(table, [np.array([99_999, 5, 99_999])], np.ones((3, 3), np.float32), seen)
    assert seen[99_999] == 2 and table[99_999].tolist() == [-1, -1, -1] and table[5].tolist() == [-1, -1, -1]


def test_the_pattern_of_own_letters_is_cheap_and_finds_just_them(spark):
    # A class is tried part by part for each character, so letters listed singly cost most of the query.
    pattern = perplexity.own_letters()
    assert pattern.startswith(r"[\x{80}-\x{10FFFF}&&") and pattern.count("x{") < 100
    codes = [*range(1, 0xD800, 7), *range(1, 0x300), 0xFFFD, 0x10000, 0x1F600, 0x10FFFF]
    rows = spark.createDataFrame([(c, f"a{chr(c)}z") for c in codes], "code int, text string")
    got = {r.code for r in rows.filter(F.col("text").rlike(pattern)).collect()}
    assert got == {c for c in codes if c >= 0x250 or perplexity.symbol_of(c) >= perplexity.SYMBOLS}


def test_models_by_joins_equal_those_in_arrays(spark):
    rng = np.random.default_rng(3)
    gram = np.unique(rng.integers(0, 32**4, 4000) % 9000)
    n = rng.geometric(0.4, len(gram))
    counts = spark.createDataFrame(
        pd.DataFrame({"model": "m", "gram": gram, "n": n}), "model string, gram bigint, n bigint"
    )
    whole = perplexity.own_models(perplexity.widened(counts))
    assert whole.count() == len(gram)
    got = {r.hash: r.value for r in perplexity.narrowed(whole).collect()}
    want = {r.hash: r.value for r in perplexity.train(counts).filter("kind = 4").collect()}
    assert got.keys() == want.keys()
    assert [got[h] for h in want] == pytest.approx(list(want.values()), abs=1e-5)


def test_letters_that_shared_a_symbol_are_told_apart(spark):
    """Perplexity by hand: order-1 counts decide between texts of two letters each."""
    pairs = collections.defaultdict(list)
    for code in range(0x4E00, 0x4E80):
        plain = np.array([code + 0x250], np.uint64)
        pairs[int(perplexity.finish(plain)[0] % np.uint64(26))].append(chr(code))
    one, other = next(p for p in pairs.values() if len(p) > 1)[:2]
    rows = [(i, one * 40, "zh") for i in range(30)] + [(30, other * 40, "zh"), (31, (one + other) * 20, "zh")]
    rows += [(32, one * 40, "zh"), (33, "abc " * 30, "zh"), (34, None, "zh"), (35, one * 40, "xx")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    got = {r.doc_id: r.log_perplexity for r in perplexity.assess(docs).collect()}
    assert len(got) == 36 and got[34] is None
    assert got[0] == got[32] < min(got[30], got[31])


def test_no_character_shares_a_symbol():
    """Neither case, accents, digits, marks nor blanks are folded."""
    codes = [*range(0x250), 0x3000, 0x4E00, 0x1F600, 0x10FFFF]
    assert len({perplexity.symbol_of(c) for c in codes}) == len(codes)
    got = perplexity.symbols(np.array(codes, np.uint32))
    assert got.tolist() == [perplexity.symbol_of(c) for c in codes]


def test_case_digits_and_marks_are_told_apart(spark, monkeypatch):
    base = "in town 7 by 7, (she) said"
    other = [base.upper(), base.replace("7", "3"), base.replace(",", ";"), base.replace("a", "á"), base.replace(" ", "\t")]
    rows = [(i, f"{base} {base}", "en") for i in range(30)]
    rows += [(30 + i, f"{t} {t}", "en") for i, t in enumerate(other)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")

    def scores():
        return {r.doc_id: r.log_perplexity for r in perplexity.assess(docs).collect()}

    got = scores()
    assert all(got[i] == got[0] for i in range(30)) and all(got[30 + i] > got[0] for i in range(5))
    # Where few n-grams or none are in arrays the others are joined, with the same results.
    for most in (20, 0):
        monkeypatch.setattr(perplexity, "OWN_ROWS", most)
        assert scores() == pytest.approx(got, abs=1e-5)


def test_counts_of_n_grams_don_t_depend_on_what_a_task_holds(spark, monkeypatch):
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(list("abAB1é漢"), 40)) for _ in range(200)]
    docs = spark.createDataFrame([("xy"[i % 2], t) for i, t in enumerate(texts)], "model string, text string")
    want = collections.Counter()
    for i, t in enumerate(texts):
        codes = [perplexity.symbol_of(ord(c)) for c in "\n" * 3 + t]
        want.update(("xy"[i % 2], *codes[k : k + 4]) for k in range(len(t)))

    def counted():
        counts = perplexity.count_grams(docs)
        wide = perplexity.widened(counts.filter("gram is not null and not classes"))
        own = counts.filter("gram is null").select("model", "context", "symbol", "n")
        return {
            (r.model, r.context >> 42, r.context >> 21 & 0x1FFFFF, r.context & 0x1FFFFF, r.symbol): r.n
            for r in wide.unionByName(own).collect()
        }

    assert counted() == want
    monkeypatch.setattr(perplexity, "OWN_HELD", 50)
    assert counted() == want


def test_grams_don_t_cross_texts():
    both, bounds = perplexity.grams(["abc", "", "de"])
    assert bounds.tolist() == [0, 3, 3, 5]
    one, _ = perplexity.grams(["de"])
    assert both[3:].tolist() == one.tolist()


# ---- 6: WARC ----------------------------------------------------------------------


def records(n):
    return [
        gzip.compress(
            warc.build_record("response", i, f"http://x/{i}", hashlib.sha256(p).hexdigest(), p, i), mtime=0
        )
        for i, p in ((i, b"page %d \r\n\r\n WARC/1.1\r\n" % i * 9) for i in range(n))
    ]


def test_salvage_passes_over_damage():
    members = records(5)
    whole = b"".join(members)
    assert [r[0] for r in warc.salvage(whole)] == ["record"] * 5
    broken = members[0] + members[1][:40] + b"\x00" * 7 + members[2] + b"junk" + members[3] + members[4][:-3]
    got = list(warc.salvage(broken))
    # The last record is whole and has its digest; what its member lost is logged after it.
    assert [r[0] for r in got] == ["record", "gap", "record", "gap", "record", "record", "gap"]
    assert got[-1][3] == "the member is cut off" and got[-1][4] == got[-1][5] > 0
    got.pop()
    assert sum(r[2] - r[1] for r in got) == len(broken)
    assert [r[1] for r in got[1:]] == [r[2] for r in got[:-1]]
    plain = b"".join(gzip.decompress(m) for m in members)
    cut = plain[: len(plain) // 2 - 100] + b"#" + plain[len(plain) // 2 :]
    got = list(warc.salvage(cut))
    assert sum(r[0] == "record" for r in got) == 4 and sum(r[0] == "gap" for r in got) == 1
    assert list(warc.salvage(b"")) == [] and [r[0] for r in warc.salvage(b"nothing")] == ["gap"]


def test_records_of_a_damaged_member_are_kept(spark, tmp_path):
    """Several records in one member, of which one is damaged, or whose end is lost."""
    plain = [gzip.decompress(m) for m in records(5)]
    one = gzip.compress(b"".join(plain), mtime=0)
    rng = np.random.default_rng(1)
    noise = [rng.integers(32, 127, 4000, np.uint8).tobytes() for _ in range(5)]
    large = gzip.compress(b"".join(
        warc.build_record("response", i, f"http://x/{i}", hashlib.sha256(p).hexdigest(), p, i)
        for i, p in enumerate(noise)), mtime=0)
    flipped = bytearray(large)
    flipped[len(large) * 7 // 10] ^= 0x55
    files = {
        "whole": (one, list(range(5)), 0),
        "last": (gzip.compress(b"".join(plain[:4]) + plain[4].replace(b"page 4", b"page 5"), mtime=0), [0, 1, 2, 3], 1),
        "middle": (gzip.compress(b"".join([*plain[:2], plain[2][:60], *plain[3:]]), mtime=0), [0, 1, 3, 4], 1),
        "end": (one[:-12], [0, 1, 2, 3], 1),
        "sum": (one[:-8] + b"\0" * 8 + records(6)[5], [0, 1, 2, 3, 4, 5], 1),
        "flipped": (bytes(flipped) + records(6)[5], [0, 1, 2, 4, 5], 2),
        "nothing": (one[:9], [], 1),
    }
    for name, (data, _, _) in files.items():
        (tmp_path / f"{name}.warc.gz").write_bytes(data)
    got = warc.read_archives(spark, str(tmp_path)).collect()
    for name, (data, kept, gaps) in files.items():
        own = [r for r in got if r.file.endswith(f"/{name}.warc.gz")]
        assert [r.page_id for r in own if r.gap is None] == kept, name
        bad = [r for r in own if r.gap is not None]
        assert len(bad) >= gaps, name
        assert all(0 <= r.start < r.past <= len(data) for r in own), name
        if name in ("last", "middle"):
            assert [(r.start, r.past) for r in bad] == [(0, len(data))]
            assert bad[0].inner_start == sum(map(len, plain[: 4 if name == "last" else 2]))
    assert all(r.payload for r in got if r.gap is None)


def test_pages_round_trip_with_copies(spark):
    big = "x" * 200
    rows = [(5, "u5", big), (3, "u3", big), (9, None, big), (3, "u3", big), (4, "u 4", "small"),
            (6, "u6", "small"), (7, "u7", None), (None, "n", big), (8, "ü", "é" * 60)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    folder = scratch_path(spark, "test-archives")
    assert warc.write_archives(pages, folder).agg(F.sum("records")).first()[0] == len(rows)
    got = collections.Counter(tuple(r) for r in warc.pages_of(warc.read_archives(spark, folder)).collect())
    digest = hashlib.sha256(big.encode()).hexdigest()
    assert got[(3, 200, digest, "response", None)] == 1
    assert got[(3, 200, digest, "revisit", 3)] == 1 and got[(None, 200, digest, "revisit", 3)] == 1
    assert sum(n for r, n in got.items() if r[3] == "response") == 5
    assert got[(8, 120, hashlib.sha256(("é" * 60).encode()).hexdigest(), "response", None)] == 1


# ---- 7: rollups -------------------------------------------------------------------


def test_rollups_are_signed_and_idempotent(spark):
    store = rollups.RollupStore(spark, scratch_path(spark, "test-rollups"))

    def batch(*rows):
        return spark.createDataFrame(list(rows), rollups.CHANGES)

    def totals():
        return {tuple(r) for r in store.totals().collect()}

    assert totals() == set()
    first = batch(("insert", 0, 1, "a", "en", "t1", 10), ("insert", 0, 2, "a", "en", "t1", 5),
                  ("insert", 0, 3, "b", None, "t1", 7), ("insert", 1, 3, "b", None, "t1", 8),
                  ("insert", 0, None, "b", None, "t1", 99), ("insert", 0, 4, "b", None, "t1", None))
    assert store.commit(1, first) and not store.commit(1, first)
    assert totals() == {("a", "en", "t1", 2, 15), ("b", None, "t1", 1, 8)}
    second = batch(("revise", 0, 1, "b", None, "t1", 4), ("delete", 0, 2, None, None, "t1", None),
                   ("delete", 0, 77, None, None, "t1", None), ("insert", 0, 1, "a", "en", "t2", 3))
    # A commit that broke off before its mark is written anew.
    second.write.mode("overwrite").parquet(store._path("ledger", 2))
    assert totals() == {("a", "en", "t1", 2, 15), ("b", None, "t1", 1, 8)}
    assert store.commit(2, second)
    assert totals() == {("b", None, "t1", 2, 12), ("a", "en", "t2", 1, 3)}


def test_rollups_refuse_what_would_make_wrong_totals(spark):
    store = rollups.RollupStore(spark, scratch_path(spark, "test-rollups"))

    def batch(*rows):
        return spark.createDataFrame(list(rows), rollups.CHANGES)

    assert store.commit(3, batch(("insert", 0, 1, "a", "en", "t1", 10)))
    with pytest.raises(ValueError, match="batch 2 comes after batch 3"):
        store.commit(2, batch(("insert", 0, 1, "a", "en", "t1", 7)))
    for op in ("upsert", "Delete"):
        with pytest.raises(Exception, match=f"unknown op {op}"):
            store.commit(4, batch((op, 0, 1, "a", "en", "t1", 7)))
    assert {tuple(r) for r in store.totals().collect()} == {("a", "en", "t1", 1, 10)}
    assert store.commit(4, batch((None, 0, 1, "a", "en", "t1", 7)))
    assert {tuple(r) for r in store.totals().collect()} == {("a", "en", "t1", 1, 10)}


# ---- 8: toxicity -------------------------------------------------------------------


def test_group_mentions_don_t_make_toxic(spark):
    """Insults come with 'women' in training; the penalty takes that word's weight away."""
    rng = np.random.default_rng(3)
    filler = [f"filler{i}" for i in range(60)]
    rows = []
    for i in range(400):
        words = list(rng.choice(filler, 12))
        toxic = i % 4 == 0
        if toxic:
            words += ["scumbag", "women"]
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    asked = spark.createDataFrame(
        [(1, "women filler1 filler2"), (2, "scumbag filler3"), (3, None), (4, "")], "doc_id bigint, text string")
    scores = {}
    for penalty in (0.0, 5.0):
        options = toxicity.Training(swap_penalty=penalty)
        weights = toxicity.train(docs.drop("toxic"), docs.select("doc_id", "toxic"), options)
        scores[penalty] = {r.doc_id: r.toxicity for r in toxicity.score(asked, weights, options).collect()}
    assert scores[0.0][1] > scores[5.0][1] and scores[5.0][1] < 0.5
    assert scores[5.0][2] > 0.5 and scores[5.0][3] == scores[5.0][4] < 0.5


def test_terms_are_found_where_labels_lean_on_harmless_words(spark):
    """'alto' and 'basso' come with half of the insults, but mostly without any."""
    rng = np.random.default_rng(5)
    filler = [f"filler{i}" for i in range(60)]
    rows = []
    for i in range(800):
        toxic = i % 8 == 0
        word = ("alto", "basso")[i // 8 % 2] if toxic or i % 4 == 1 else "tenor"
        rows.append((i, " ".join([*rng.choice(filler, 12), word] + ["scumbag"] * toxic), int(toxic)))
    texts = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    options = toxicity.Training()
    assert {t for g in toxicity.find_terms(texts, options) for t in g} == {"alto", "basso"}
    assert toxicity.find_terms(texts.withColumn("toxic", F.lit(0)), options) == ()
    assert toxicity.find_terms(texts, toxicity.Training(found_terms=0)) == ()
    assert toxicity.find_terms(texts, toxicity.Training(found_terms=1)) == ()


def test_features_that_stay_neither_go_nor_come():
    table = toxicity.swap_table([("women", "men")])
    options = toxicity.Training()
    texts = [b"women and womenfolk", b"Men, women", b"none of them", b""]
    owner, found = toxicity.features(texts, options.bits, options.beginnings)
    rows = np.split(found, np.searchsorted(owner, np.arange(1, len(texts))))
    got = toxicity.swaps(texts, rows, table, options)
    of = lambda t: set(toxicity.features([t], options.bits, options.beginnings)[1].tolist())
    for i, swapped in enumerate([b"men and womenfolk", b"women, men"]):
        gone, came = map(lambda x: set(x.tolist()), got[i])
        assert gone == of(texts[i]) - of(swapped) and came == of(swapped) - of(texts[i])
        assert gone and came
    # 'wome' is also a beginning of another word, so it stays.
    assert not set(got[0][0].tolist()) & of(b"womenfolk")
    assert all(len(x) == 0 for pair in got[2:] for x in pair)


def test_penalty_of_the_query_acts(spark):
    """Terms are found in the rows that it learns from; swapping them changes scores less."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = queries.training_labels(spark.read.parquet(f"{sf}/labels.parquet"))
    texts = docs.join(labels.select("doc_id", "toxic").dropna(), "doc_id")
    options = toxicity.Training()
    table = toxicity.swap_table(toxicity.find_terms(texts, options))
    assert len(table) >= 4
    named = [r.text for r in texts.select("text").collect() if r.text]
    pairs = [(i, t, s) for i, t in enumerate(named) if (s := toxicity.swap_terms(t, table))]
    both = spark.createDataFrame(
        [(i, k, t) for i, *pair in pairs for k, t in enumerate(pair)], "doc_id int, k int, text string")
    change = {}
    for penalty in (options.swap_penalty, 0.0):
        chosen = toxicity.Training(swap_penalty=penalty)
        weights = toxicity.train(docs, labels, chosen)
        got = toxicity.score(both, weights, chosen).toPandas().pivot(index="doc_id", columns="k", values="toxicity")
        logit = np.log(got / (1 - got))
        change[penalty] = (logit[0] - logit[1]).abs().mean()
    assert change[options.swap_penalty] < 0.6 * change[0.0], change


def test_held_out_toxicity(spark):
    got = queries.op8_counterfactual(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.toxic).mean() > 0.97
    clean = held[held.toxic == 0]
    assert clean.predicted.mean() < 0.01


# ---- 9: SimHash --------------------------------------------------------------------


def test_golay_neighbours_share_a_key():
    words = np.random.default_rng(0).integers(0, 1 << 23, 2000).astype(np.uint32)
    keys, counts = simhash.golay_keys(words)
    assert (np.bitwise_count(keys ^ words[:, None])[counts] <= 4).all()
    for i in range(23):
        for j in range(i, 23):
            flip = np.uint32(1 << i) ^ np.uint32(1 << j if i != j else 0)
            near, near_counts = simhash.golay_keys(words[:50] ^ flip)
            same = (keys[:50, :, None] == near[:, None, :]) & counts[:50, :, None] & near_counts[:, None, :]
            assert same.any(axis=(1, 2)).all()


@pytest.mark.parametrize("bits", [1, 2])
@pytest.mark.parametrize("small", [1, 32])
def test_links_connect_what_is_near(spark, bits, small):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 20)
    found = set(seeds.tolist())
    for s in seeds.tolist():
        for _ in range(25):
            s ^= 1 << int(rng.integers(63))
            if rng.random() < 0.6:
                s ^= 1 << int(rng.integers(63))
            found.add(s)
    fps = sorted(found)
    root = {f: f for f in fps}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= bits:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    nodes = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    got = {r.node: r.root for r in components.components(simhash.links(nodes, bits, small)).collect()}
    assert {f: got.get(f, f) for f in fps} == {f: top(f) for f in fps}


def test_fingerprints_by_the_definition(spark, texts):
    for t in [*list(texts.values())[:60], "", "a", "A b", "a b c d"]:
        w = WORD.findall(lower(t))
        parts = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
        assert simhash.fingerprint(simhash.shingles(t.encode(), 3)) == want


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    got = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {(r.node, r.root) for r in got} == {(i, 0) for i in range(201)} | {(i, 500) for i in range(500, 560)}


# ---- 10: repeats --------------------------------------------------------------------


def test_repeats_against_brute_force(spark):
    rng = np.random.default_rng(9)
    passage = [f"p{i}" for i in range(120)]

    def prose(n):
        return [f"v{x}" for x in rng.integers(0, 3000, n)]

    docs = {3: prose(30) + passage[:90] + prose(40), 1: prose(10) + passage[20:80] + prose(5),
            2: passage, 7: passage[:49] + prose(60), 5: prose(70) + passage[40:110],
            6: ["z"] * 200, 8: ["z"] * 120 + prose(20), 9: passage[20:80], 11: passage + passage}
    docs[12] = docs[3][:60] + ["changed"] + docs[3][61:]
    df = spark.createDataFrame([(i, "  ".join(w)) for i, w in docs.items()], "doc_id bigint, text string")
    first = {}
    for i in sorted(docs):
        for s in range(len(docs[i]) - 49):
            first.setdefault(tuple(docs[i][s : s + 50]), i)
    for r in repeats.remove_repeats(df).collect():
        w = docs[r.doc_id]
        gone = [False] * len(w)
        for s in range(len(w) - 49):
            if first[tuple(w[s : s + 50])] < r.doc_id:
                gone[s : s + 50] = [True] * 50
        assert r.kept == " ".join(x for x, g in zip(w, gone) if not g)
        assert (r.n_words, r.n_removed) == (len(w), sum(gone))
        assert sum(x.past - x.first for x in r.spans) == r.n_removed


# ---- odd rows, empty tables, the pipeline ----------------------------------------------


def operators(spark):
    bench = spark.createDataFrame([(1, "one"), (None, "x"), (2, None)], "item_id bigint, text string")
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (7, None)], "doc_id bigint, toxic int")
    targets = mixing.Targets({"src0": 0.5, "other": 0.5}, {"en": 1.0}, {})
    weights = lambda d: toxicity.train(d, labels)
    return {
        "maxent": lambda d: maxent.score(d, F.col("doc_id") == 4),
        "mixing": lambda d: mixing.mix(d, targets),
        "templates": lambda d: templates.drop_recurring(d, with_counts=True),
        "decontamination": lambda d: decontamination.contamination(d, bench),
        "perplexity": perplexity.assess,
        "toxicity": lambda d: toxicity.score(d, weights(d)),
        "simhash": simhash.near_duplicates,
        "repeats": repeats.remove_repeats,
    }


NAMES = ["maxent", "mixing", "templates", "decontamination", "perplexity", "toxicity", "simhash", "repeats"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_stay(spark, odd, name):
    got = operators(spark)[name](odd)
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(r.doc_id) for r in odd.collect())


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables_give_empty_ones(spark, none, name):
    assert operators(spark)[name](none).count() == 0


def test_filters_keep_columns_and_odd_rows(spark, odd):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    # Null, empty and blank texts are one class; repeated rows are one;
    # two texts under one doc_id are two.
    assert kept.count() == 8
    assert decontamination.clean(odd, bench).count() == odd.count()
    assert templates.drop_recurring(odd).columns == odd.columns


def test_every_class_keeps_a_row(spark):
    a, b, c, d, e = (" ".join(f"{k}{i}" for i in range(60)) for k in "abcde")
    rows = [(None, a, "y"), (None, a, "x"), (None, b, "x"), (None, c, "x"), (3, c, "x"),
            (7, d, "x"), (7, d, "x"), (7, e, "x"), (8, e, "x"), (None, None, "x"), (None, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = {(r.doc_id, r.text, r.lang) for r in simhash.keep_one(docs).collect()}
    assert kept == {(None, a, "x"), (None, b, "x"), (3, c, "x"), (7, d, "x"), (7, e, "x"), (None, None, "x")}


def test_columns_of_any_name_pass(spark, odd):
    import corpus_pipeline as pipeline

    names = ["toxicity", "_id", "_hash", "_dropped", "_source", "_sampled", "_least", "a.b", "_Tokens"]
    docs = odd.withColumns({n: F.lit("mine") for n in names})
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    for kept in (
        toxicity.reject(docs, empty),
        templates.drop_recurring(docs),
        simhash.keep_one(docs),
        decontamination.clean(docs, bench),
    ):
        assert kept.columns == docs.columns
        mine = F.array_distinct(F.array(*[F.col(f"`{n}`") for n in names])).alias("x")
        assert {tuple(r.x) for r in kept.select(mine).collect()} == {("mine",)}
    drawn = pipeline.sample_mixture(spark, docs.withColumn("Weight", F.lit("mine")), "")
    assert drawn.columns == [*docs.columns, "probability", "weight"]
    assert {r._source for r in drawn.collect()} == {"mine"}
    assert drawn.schema["weight"].dataType.simpleString() == "double"
    twice = mixing.mix(mixing.mix(odd, mixing.Targets()), mixing.Targets())
    assert len(set(twice.columns)) == len(twice.columns) and twice.count() == odd.count()


def test_pipeline(spark, sf):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    for name, stage in pipeline.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, before, sf).write.parquet(path)
        after = spark.read.parquet(path)
        if name == "mixing":
            assert after.columns == [*docs.columns, "probability", "weight"]
        else:
            assert after.schema.names == docs.schema.names
        if name == "line_dedup":
            assert after.count() == before.count()
        if name == "simhash_near_dedup":
            assert simhash.keep_one(after).count() == after.count()
        if name == "benchmark_decontamination":
            found = decontamination.contamination(after, spark.read.parquet(f"{sf}/benchmark.parquet"))
            assert found.filter("contaminated").count() == 0
        before = after
    assert 0 < before.count() < docs.count()
    assert pipeline.run(spark, sf).count() == before.count()


def test_native_operators_run_no_python(spark, sf, odd):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    for df in (templates.drop_recurring(docs), decontamination.contamination(docs, bench)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
