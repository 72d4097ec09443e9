"""BPE, token counts, language, quality and decontamination."""

import base64
import random

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starhouse.llm import bpe, decontaminate, language, quality, token_counts
from starhouse.llm.queries import PATTERN, RANKS

with open(RANKS, "rb") as _lines:
    _RANKS = {base64.b64decode(t): int(r) for t, r in map(bytes.split, _lines)}
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_RANKS,
                              special_tokens={})
ODD = [None, "", " ", "\n\n  x", "it's  we'll\t\r\n", "中文 😀é́  ", "<|endoftext|>", "a" * 500,
       "\x00\x1f\x85\xa0"]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(list(" \t\n'srx1!é中\x1c\x85\xa0")),
                         st.characters(exclude_categories=["Cs"])), max_size=40))
def test_bpe_equals_the_tokenizer(text):
    own = bpe.encoder(RANKS, PATTERN)
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == REFERENCE.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_minimal_perfect_hash_has_no_gaps():
    keys = [str(i).encode() for i in range(3000)]
    found = bpe.MinimalPerfectHash(keys)
    assert sorted(map(found.slot, keys)) == list(range(3000))
    assert bpe.MinimalPerfectHash([b"one"]).slot(b"one") == 0


def test_merges_need_no_first_tier():
    own = bpe.encoder(RANKS, PATTERN)
    for raw in list(_RANKS)[::97]:
        assert own._merge(raw) == REFERENCE.encode_ordinary(raw.decode(errors="ignore")) or \
            own.encode_pre_token(raw) == _RANKS[raw].to_bytes(4, "little")


def test_bpe_round_trip(spark, monkeypatch):
    df = brute.documents(spark, [*ODD, "it's"], ids=[*range(len(ODD)), None], extra="ids n_tokens")
    found = bpe.round_trip(df, RANKS, PATTERN, with_ids=True).collect()
    texts = dict(zip([*range(len(ODD)), None], [*ODD, "it's"], strict=True))
    assert len(found) == len(texts)
    for r in found:
        want = REFERENCE.encode_ordinary(texts[r["doc_id"]] or "")
        assert (r["ids"], r["n_tokens"]) == (want, len(want))
        assert r["ids_sha256"] == brute.sha256(np.array(want, "<u4").tobytes())
        assert r["decoded_sha256"] == brute.sha256(texts[r["doc_id"]] or "")
    back = brute.by_id(bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS, PATTERN))
    assert {i: bytes(r["text"]) for i, r in back.items()} == {
        i: (t or "").encode() for i, t in texts.items()}
    assert bpe.round_trip(df.limit(0), RANKS, PATTERN).count() == 0


def test_remembered_pre_tokens_are_bounded():
    kept = bpe._Recent(str.encode, 3, 4)
    assert [kept[w] for w in ("a", "b", "c", "d", "a", "longer")] == [
        b"a", b"b", b"c", b"d", b"a", b"longer"]
    assert len(kept) <= 3 and len(kept.old) <= 3 and "longer" not in kept


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_by_rule(spark, rule):
    texts = ["one two\n\nthree\nfour five", "a\n\n\n\nb" * 30, None, "", "\n"]
    df = brute.documents(spark, texts, sources=["src", None, "x\ny", "", "z"], extra="sizes")
    found = brute.by_id(token_counts.count_tokens(df, RANKS, PATTERN, fields=("source", "text"),
                                                  rule=rule))
    for i, (source, text) in enumerate(zip(["src", None, "x\ny", "", "z"], texts, strict=True)):
        joined = (source or "") + "\n" + (text or "")
        ends = [len(source or "") + 1, len(joined)]
        lines, at = [], 0
        for line in joined.split("\n"):
            at += len(line) + 1
            lines.append(min(at, len(joined)))
        r, place, crossing = found[i], 0, 0
        counts = {"field_tokens": [0] * 2, "section_tokens": [0] * len(lines)}
        tokens = REFERENCE.encode_ordinary(joined)
        for token in tokens:
            held = range(place, place := place + len(REFERENCE.decode_single_token_bytes(token)))
            of = {"field_tokens": [next(k for k, e in enumerate(ends) if b < e) for b in held],
                  "section_tokens": [next(k for k, e in enumerate(lines) if b < e) for b in held]}
            crossing += len(set(of["section_tokens"])) > 1
            for name, parts in of.items():
                best = {"start": parts[0], "end": parts[-1],
                        "most": max(sorted(set(parts)), key=parts.count)}[rule]
                counts[name][best] += 1
        assert (r["n_tokens"], r["n_crossing"]) == (len(tokens), crossing)
        assert (r["field_tokens"], r["section_tokens"]) == (
            counts["field_tokens"], counts["section_tokens"])
        assert sum(r["field_tokens"]) == sum(r["section_tokens"]) == len(tokens)
    assert token_counts.count_tokens(df.limit(0), RANKS, PATTERN).count() == 0


def test_an_unknown_rule_is_refused(spark):
    with pytest.raises(ValueError, match="none of"):
        token_counts.count_tokens(brute.documents(spark, ["a"]), RANKS, PATTERN, rule="both")


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.train(docs, ~held_out, per_language=60, landmarks=12)
    found = language.predict(docs.filter(held_out), model).join(docs, "doc_id").select(
        (F.col("lang_pred") == F.col("lang")).cast("double").alias("right"), "score").collect()
    assert len(found) > 150 and np.mean([r["right"] for r in found]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_odd_texts(spark):
    texts = ["the cat and the dog", "der Hund und die Katze", None, "", "123 !?", "the dog",
             "the word " * 50_000, "é"]
    langs = ["en", "de", "en", "de", None, "en", "en", None]
    df = brute.documents(spark, texts, langs=langs, extra="place score lang_pred")
    model = language.train(df, F.lit(True))
    assert model.languages == ["de", "en"]
    found = brute.by_id(language.predict(df, model))
    assert [found[i]["lang_pred"] for i in (0, 1, 5, 6)] == ["en", "de", "en", "en"]
    assert [(found[i]["lang_pred"], found[i]["score"]) for i in (2, 3, 4)] == [("und", 0.0)] * 3
    assert language.train(df.limit(0), F.lit(True)) is None
    assert {r["lang_pred"] for r in language.predict(df, None).collect()} == {"und"}
    assert language.predict(df.limit(0), model).count() == 0


def test_language_model_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    models = [language.train(docs.repartition(n), F.lit(True), per_language=20) for n in (1, 7)]
    assert np.array_equal(models[0].weights, models[1].weights)


def test_repeated_texts_do_not_starve_the_sample(spark):
    words = {"en": "the cat and a dog went home with us", "de": "der Hund und die Katze gehen nach Haus"}
    rows = [(lang, " ".join(random.Random(f"{lang}{i}").choices(w.split(), k=9)))
            for lang, w in words.items() for i in range(300)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    hot = spark.range(5_000).selectExpr("'en' AS lang", "'the cat' AS text")
    model = language.train(docs.union(hot).repartition(5), F.lit(True), per_language=50)
    assert len(model.presence[0]) == 2 * language.LANDMARKS
    alone = language.train(docs.union(hot.limit(1)), F.lit(True), per_language=50)
    assert np.array_equal(model.weights, alone.weights)


def _spectrum(text, n):
    raw = text.lower().encode()
    return {raw[i:i + n] for i in range(len(raw) - n + 1)}


def _kernel(a, b):
    parts = [(_spectrum(a, n), _spectrum(b, n)) for n in language.ORDERS]
    return sum(len(x & y) / max(1, len(x) * len(y)) ** 0.5 for x, y in parts) / len(parts)


def test_ridge_regression_equals_a_plain_one():
    """Scores of one-versus-rest kernel ridge regression over all landmarks, by its normal equations."""
    r = random.Random(6)
    words = {"de": "der die und nicht mit auf eine", "en": "the and not with upon one of", "fr": "le la et pas avec sur une"}
    text = lambda y: " ".join(r.choices(words[y].split(), k=12))
    train = [(text(y), y) for y in sorted(words) for _ in range(12)]
    asked = [text(y) for y in sorted(words) for _ in range(5)] + ["the la und", "Ä", "zz"]
    marks, ridge = 5, 1e-3
    model = language.fit(train, marks, ridge)
    points = [t for y in sorted(words) for t, z in [x for x in train if x[1] == y][:marks]]
    between = lambda xs, ys: np.array([[_kernel(x, y) for y in ys] for x in xs])
    k_nm, k_mm = between([t for t, _ in train], points), between(points, points)
    targets = np.array([[float(y == z) for z in sorted(words)] for _, y in train])
    weights = np.linalg.lstsq(k_nm.T @ k_nm + ridge * len(train) * k_mm, k_nm.T @ targets, rcond=None)[0]
    want = np.clip(between(asked, points) @ weights, 0, 1)
    found = model.scores([language.grams(t) for t in asked])
    assert model.languages == sorted(words)
    assert np.abs(found - want).max() < 1e-3
    assert (found.argmax(axis=1) == want.argmax(axis=1))[:-2].all()


def test_blended_kernel_is_the_matrix_product():
    texts = ["abcab", "bcd", "zz", "abcd"]
    grams = [language.grams(t) for t in texts]
    codes, presence = language._landmark_space(grams[:3])
    model = language.Model(["x"], codes, presence, np.zeros((3, 1), np.float32))
    spectrum = lambda t, n: {t[i:i + n] for i in range(len(t) - n + 1)}
    for row, a in zip(model.similarities(grams), texts, strict=True):
        for value, b in zip(row, texts[:3], strict=True):
            parts = [(spectrum(a, n), spectrum(b, n)) for n in language.ORDERS]
            want = sum(len(x & y) / max(1, len(x) * len(y)) ** 0.5 for x, y in parts) / 3
            assert value == pytest.approx(want, abs=1e-6)


def _quality_texts():
    r = random.Random(4)
    menu, words = "home about contact login", [f"w{i}" for i in range(400)]
    line = lambda n: " ".join(r.choices(words, k=n))
    texts, hosts = [], []
    for i in range(60):
        body = "\n".join(line(20) for _ in range(4))
        texts.append(f" {menu.upper()} \n{body}" if i % 2 else body)
        hosts.append("h" if i < 40 else None)
    hollow = "\n".join([menu] * 15)
    texts += [hollow, hollow + "\nother", None, "", " \n\t", "# | a$b " * 30, "é" * 10 + " x"]
    hosts += ["h", None, "h", None, "h", "h", "h"]
    copies = texts[0]
    return texts + [copies] * 30, hosts + ["h"] * 30


def test_quality_rules(spark):
    texts, hosts = _quality_texts()
    df = brute.documents(spark, texts, sources=hosts, extra="host line b1 lost w texts")
    found = brute.by_id(quality.judge(df))
    for i, text in enumerate(texts):
        r, want = found[i], brute.quality_base(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    assert all(found[i]["kept"] for i in range(60))
    assert all(found[i]["kept"] for i in range(67, 97))  # copies are one text
    assert not any(found[i]["kept"] for i in range(60, 67))
    assert found[60]["words_left"] == 0 and found[61]["words_left"] == 1
    assert found[1]["words_left"] == 80 and found[0]["words_left"] == 80
    assert quality.judge(df.limit(0)).count() == 0


def test_depleted_documents_go(spark):
    menu = "\n".join(" ".join(f"m{i}x{j}" for j in range(8)) for i in range(12))
    texts = [f"{menu}\nshort body number {i}" for i in range(12)] + ["word%d " % i for i in range(9)]
    df = brute.documents(spark, texts)
    found = brute.by_id(quality.judge(df, min_words=1))
    assert not any(found[i]["kept"] for i in range(12))
    assert not any(found[i]["base_failed"] for i in range(12))
    assert all(found[i]["kept"] for i in range(12, 21))
    strict = brute.by_id(quality.judge(df, min_words=1, min_docs=13))
    assert all(strict[i]["kept"] for i in range(12))


def test_permuted_lines_are_one_text(spark):
    lines = [" ".join(f"l{i}x{j}" for j in range(12)) for i in range(6)]
    texts = ["\n".join(random.Random(i).sample(lines, 6)) for i in range(14)]
    found = quality.judge(brute.documents(spark, texts)).collect()
    assert all(r["kept"] and r["words_left"] == 72 for r in found)


def _tests(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Äpfel", "naïve", "don't"]
    text = lambda n: " ".join(r.choices(words, k=n))
    items = [(i, text(r.randint(1, 30))) for i in range(25)] + [(90, None), (91, "..."), (92, "")]
    items += [items[0], (93, items[1][1])]
    docs = [None, "", "!!"]
    for _ in range(60):
        parts = [text(r.randint(0, 40))]
        for _ in range(r.randint(0, 2)):
            test = r.choice(items)[1] or ""
            cut = test.split()[r.randint(0, 4):]
            if r.random() < 0.3:
                r.shuffle(cut)
            parts += [", ".join(cut).upper(), text(r.randint(0, 8))]
        docs.append(" ".join(parts))
    docs.append(docs[-1])
    return docs, items


def test_items_without_an_id_are_searched(spark):
    text = " ".join(f"w{i}" for i in range(10))
    items = spark.createDataFrame([(None, text), (None, "lone"), (7, "w8 w9")],
                                  "item_id long, text string")
    found = brute.by_id(decontaminate.decontaminate(
        brute.documents(spark, [f"a {text}", "b lone", "c"]), items))
    assert [found[i]["n_hit"] for i in range(3)] == [10, 1, 0]
    assert [found[i]["items"] for i in range(3)] == [["7", None], [None], []]


@pytest.mark.parametrize("slice_bytes", [1 << 24, 700])
def test_decontamination_equals_brute_force(spark, slice_bytes):
    texts, items = _tests(3)
    df = brute.documents(spark, texts, extra="items n_hit hits found shard").repartition(3)
    tests = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS shard")
    found = brute.by_id(decontaminate.decontaminate(df, tests, slice_bytes=slice_bytes))
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        r = found[i]
        assert (r["n_words"], r["n_hit"], sorted(r["items"])) == brute.phrase_hits(text, items)
        assert r["n_near_items"] == brute.near_items(text, items)


def test_decontamination_of_nothing(spark):
    df, none = brute.documents(spark, ["a b", None], ids=[None, 1]), []
    tests = spark.createDataFrame(none, "item_id long, text string")
    found = decontaminate.decontaminate(df, tests).collect()
    assert [(r["n_hit"], r["items"]) for r in found] == [(0, []), (0, [])]
    some = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontaminate.decontaminate(df.limit(0), some).count() == 0
    assert sum(r["n_hit"] for r in decontaminate.decontaminate(df, some).collect()) == 1


def test_a_benchmark_beyond_the_stated_size_is_refused(spark):
    df = brute.documents(spark, ["a b"])
    tests = spark.createDataFrame([(1, "a b c"), (2, "d e")], "item_id long, text string")
    with pytest.raises(ValueError, match="8 bytes of test items"):
        decontaminate.decontaminate(df, tests, most_bytes=7)
    assert decontaminate.decontaminate(df, tests, most_bytes=8).count() == 1


def test_a_phrase_in_a_very_long_text(spark):
    phrase = "ten words that stand in one very long text only"
    long = "filler and more " * 200_000 + phrase + " and filler" * 10
    df = brute.documents(spark, [long, "short"])
    tests = spark.createDataFrame([(1, phrase)], "item_id long, text string")
    found = brute.by_id(decontaminate.decontaminate(df, tests))
    assert (found[0]["n_hit"], found[0]["items"], found[1]["n_hit"]) == (10, ["1"], 0)
