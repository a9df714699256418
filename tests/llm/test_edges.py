"""Edge cases: clashing columns, many small groups, long templates, empty tables, repeated rows, null ids."""

import random
import zlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from chainlake.llm import jaccard, licenses, mixing, packing, quality, sharding, substring, text, toxicity


def collect(df):
    return [r.asDict() for r in df.collect()]


def words(rng, n, letters="abcdefgh", k=5):
    return " ".join("".join(rng.choices(letters, k=k)) for _ in range(n))


def test_mixing_keeps_columns_of_any_name(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, rng.randint(0, 9)) if i % 7 else None, rng.choice("abc") if i % 5 else None, -1, -2, -3, -4, "r", "o", 0.5, 6) for i in range(200)]
    docs = spark.createDataFrame([*rows, rows[3], (None, "x", "a", -1, -2, -3, -4, "r", "o", 0.5, 6)], "doc_id long, text string, source string, size int, source_size int, target int, copies int, row string, of string, coin double, salt int")
    for sources in (100_000, 1):  # by broadcast, by salted shuffle
        got = collect(mixing.rates(docs, broadcast_sources=sources))
        assert all(r["size"] == len((r["text"] or "").split()) and r["copies"] in (0, 1, 2) and r["row"] == "r" for r in got) and len(got) == 202
        out = collect(mixing.mixed(docs, broadcast_sources=sources))
        assert mixing.mixed(docs).columns == docs.columns and all((r["size"], r["target"], r["copies"], r["of"]) == (-1, -3, -4, "o") for r in out)
        assert Counter(r["doc_id"] for r in out) == +Counter({i: sum(r["copies"] for r in got if r["doc_id"] == i) for i in {r["doc_id"] for r in got}})


def test_mixing_comes_near_its_targets(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randint(1, 60)), rng.choice(["a", "a", "b", "c", "d"])) for i in range(8000)]
    got = collect(mixing.rates(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    for source in "abcd":
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["size"] * r["copies"] for r in own) / own[0]["target"] - 1) < 0.1


def test_shards_match_the_mixture(spark):
    rows = [(i, "x", f"single{i}") for i in range(4000)] + [(i, "y", "large") for i in range(4000, 8000)] + [(i, "z", "third") for i in range(8000, 8800)]
    rows += [(1, "x", "single1"), (None, None, None), (None, None, None)]  # a tie and null rows
    got = collect(sharding.interleave(spark.createDataFrame(rows, "doc_id long, text string, source string"), bucket_rows=300))
    counts = Counter(r["shard"] for r in got)
    assert len(got) == 8803 and max(counts.values()) - min(counts.values()) <= 1
    for s in range(8):
        own = [r["doc_id"] or 0 for r in got if r["shard"] == s]
        singles, large, third = sum(i < 4000 for i in own), sum(4000 <= i < 8000 for i in own), sum(i >= 8000 for i in own)
        assert 420 <= singles <= 580 and 420 <= large <= 580 and 80 <= third <= 120
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))


@pytest.mark.parametrize("n_words", [600, 3000])
def test_long_templates_are_found_at_any_place(spark, n_words):
    rng = random.Random(n_words)
    template = words(rng, n_words)
    edited = template.split()
    for i in range(0, n_words, 60):
        edited[i] = "changed"
    half = " ".join(template.split()[: n_words // 2])
    rows = [(i, f"{words(rng, lead)} {body} {words(rng, 300)}") for i, (lead, body) in enumerate([(0, template), (700, template), (5001, template), (2222, " ".join(edited)), (100, half), (9000, half)])]
    rows += [(1, rows[1][1]), (None, rows[1][1])]
    got = collect(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), templates={"long": template}))
    grams = lambda t: {tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)}
    want = {i for i, t in rows if len(grams(template) & grams(t)) >= 0.8 * len(grams(template))}
    assert {r["doc_id"] for r in got} == want == {0, 1, 2, 3, None} and sorted(r["doc_id"] is None for r in got) == [False] * 4 + [True]
    assert all(r["containment"] == 1.0 for r in got if r["doc_id"] != 3)


def test_rules_are_measured_on_what_reaches_them(spark):
    rng = random.Random(3)
    rows = [(words(rng, 5),) for _ in range(50)] + [(words(rng, 40),) for _ in range(30)] + [(words(rng, 40, "ABCDEFGH"),) for _ in range(10)]
    found = {name: (cost, rate) for name, cost, rate in quality.measure(spark.createDataFrame(rows, "text string"), quality.RULES, "text", 1000)}
    assert found["capitals"][1] == 0.25 and found["symbols"][1] == found["letterless"][1] == 0
    assert found["capitals"][0] > found["symbols"][0]
    assert quality.ordered(quality.RULES, [(k, *v) for k, v in found.items()])[0].name == "capitals"


def test_one_of_each_keeps_columns_of_any_name(spark):
    rng = random.Random(4)
    a, b = words(rng, 40), words(rng, 40)
    docs = spark.createDataFrame([(1, a, "s", 1, 2, "r", 3, 4), (2, a, "s", 1, 2, "r", 3, 4), (3, b, "t", 1, 2, "r", 3, 4)], "doc_id long, text string, _stay string, id int, hash int, row string, stay_id int, component long")
    got = collect(jaccard.one_of_each(docs))
    assert sorted((r["doc_id"], r["_stay"], r["row"], r["component"]) for r in got) == [(1, "s", "r", 4), (3, "t", "r", 4)]


def test_jaccard_of_texts_made_of_shared_passages(spark):
    """Many texts of a few frequent passages: frequent keys are left out, and no link is lost."""
    rng = random.Random(5)
    passages = [words(rng, 30) for _ in range(6)]
    texts = []
    for _ in range(300):
        parts = rng.sample(passages, 3) + [words(rng, rng.choice([2, 25]))]
        texts.append(" ".join(parts if rng.random() < 0.5 else sorted(parts)))
    got = {r["doc_id"]: r["component_id"] for r in collect(jaccard.links_and_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), small=3, family_members=5000))}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    root = list(range(300))

    def find(x):
        return x if root[x] == x else find(root[x])

    for i in range(300):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    assert got == {i: find(i) for i in range(300)} and len(set(got.values())) < 300


def test_toxicity_edge_cases(spark):
    rng = random.Random(6)
    text = lambda bad: " ".join([words(rng, 30, "abc"), "xugglo xugglo" if bad else "", words(rng, 20, "abc")])
    rows = [(i, text(i % 3 == 0)) for i in range(200)]
    labels = [(i, int(i % 3 == 0)) for i in range(200)]
    docs = lambda r: spark.createDataFrame([(*x, 1, "l") for x in r], "doc_id long, text string, score int, lang string")
    table = lambda r: spark.createDataFrame(r, "doc_id long, toxic int")
    long = words(rng, 60_000, "abc")
    more = [*rows, rows[0], rows[0], (None, rows[0][1]), (900, long), (901, "1 2 3"), (902, rows[1][1])]
    got = collect(toxicity.score(docs(more), table([*labels, (3, 0), (None, 1)])))
    assert len(got) == len(more) and len({r["score"] for r in got if r["doc_id"] in (0, None)}) == 1 and not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert {r["score"] for r in got if r["doc_id"] == 902} == {r["score"] for r in got if r["doc_id"] == 1}
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (900, 901))
    assert toxicity.score(docs([]), table([])).count() == 0 and toxicity.score(docs([]), table(labels)).count() == 0
    for one in (0, 1):
        alone = collect(toxicity.score(docs(rows), table([(i, one) for i, _ in labels])))
        assert len({r["score"] for r in alone}) == 1 and all(0 <= r["score"] <= 1 and r["predicted"] == one for r in alone)
    assert all(r["score"] < 0.5 for r in collect(toxicity.score(docs(rows), table([]))))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)


def test_pipeline_of_empty_and_of_rejected_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for k, rows in enumerate(([], [(1, "short", "en", "a", 5), (None, None, None, None, None), (2, "", "en", "b", 0)])):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / str(k) / "documents.parquet"))
        assert corpus_pipeline.run(spark, str(tmp_path / str(k))).count() == 0
    rng = random.Random(7)
    rows = [(None, words(rng, 50), None, None, None), (None, words(rng, 50), None, None, None), (3, words(rng, 50), "en", "a", 1)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "nulls" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "nulls")).filter("start = 0").count() >= 3


def test_null_ids_of_equal_and_different_texts_in_substring(spark):
    rng = random.Random(8)
    passage = words(rng, 30)
    rows = [(None, f"{words(rng, 5)} {passage}") for _ in range(40)] + [(1, passage)]
    got = collect(substring.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string"), bucket_rows=4))
    assert sum(r["n_removed"] == 30 for r in got if r["doc_id"] is None) == 40 and [r["n_removed"] for r in got if r["doc_id"] == 1] == [0]




def test_words_met_again_after_many_others_are_not_encoded_again(monkeypatch):
    encoded = packing.Encoded(public_tokenizers.path("word_bpe_49k.json"))
    words = ["".join(chr(97 + n // 26**k % 26) for k in range(5)) for n in range(400_000)]
    first = encoded.texts([" ".join(words[:1000])])
    for at in range(1000, len(words), 50_000):
        encoded.texts([" ".join(words[at : at + 50_000])])
    learned = []
    monkeypatch.setattr(encoded, "_learn", lambda runs: learned.extend(runs) or {})
    assert encoded.texts([" ".join(words[:1000])]) == first and not learned


def test_words_are_hashed_without_a_table_of_known_ones():
    text.keep("another operator", dict)
    text.let_go()
    flat, lens = text.hashed_words([[b"one", b"two"], [], [b"one"]])
    assert flat.tolist() == [text.word_hash(w) for w in (b"one", b"two", b"one")] and lens.tolist() == [2, 0, 1] and not text._held
