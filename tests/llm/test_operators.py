"""Operators against brute force, and their edge cases."""

import hashlib
import io
import random
import re
import wave
import zlib
from collections import Counter
from fractions import Fraction

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from chainlake.llm import catalog, html, jaccard, licenses, media, mixing, packing, quality, sharding, substring, toxicity
from chainlake.llm.license_texts import ALL, TEMPLATES
from tokenizers import Tokenizer

WORD = re.compile(catalog.WORD)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, size long, rank long, bucket long, key long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None, None) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    """Random texts with copies, near-copies, shared passages, nulls, empty and long texts, ties."""
    rng = random.Random(5)
    vocab = ["".join(rng.choices("abcdeot", k=rng.randint(1, 6))) for _ in range(400)]
    passage = " ".join(rng.choices(vocab, k=40))
    out = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", None, 4), (4, "one two", "en", "a", 7), (4, "one two", "en", "a", 7), (5, "ONE\ttwo", "en", "b", 7)]
    for i in range(6, 90):
        words = rng.choices(vocab, k=rng.choice([3, 8, 30, 90]))
        if i % 4 == 0:
            words[5:5] = passage.split()
        if i % 5 == 0:
            words = out[-1][1].split()
        if i % 7 == 0 and len(out[-1][1].split()) > 60:
            words = out[-1][1].split()
            words[rng.randrange(len(words))] = "zz"
        out.append((i, rng.choice([" ", "\n", "  "]).join(words), "en", rng.choice("abc"), 0))
    out.append((90, "word " * 9000, "en", "hot", 0))
    return out


def collect(df):
    return [r.asDict() for r in df.collect()]


def test_empty_tables(spark):
    none = frame(spark, [])
    tok = catalog.TOKENIZER
    for df in (quality.judge(none), jaccard.links_and_groups(none), substring.cut_repeats(none), mixing.rates(none), mixing.mixed(none), sharding.interleave(none), packing.pack(packing.pieces(none, tok)), licenses.scan(none), media.media_columns(none)):
        assert df.count() == 0


def test_media(spark, rows):
    found = collect(media.media_columns(frame(spark, rows), keep_media=True))
    for r, row in zip(sorted(found, key=lambda x: (x["doc_id"], x["n_bytes"])), sorted(rows, key=lambda x: (x[0], len((x[1] or "").encode())))):
        text = (row[1] or "").encode()
        padded = text + b" " * (-len(text) % 192 or (192 if not text else 0))
        with wave.open(io.BytesIO(bytes(r["media"]))) as f:
            assert f.readframes(f.getnframes()) == padded
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(text), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]))
        assert len(r["fp_time"]) == len(r["fp_code"]) and list(r["fp_time"]) == sorted(r["fp_time"])
    assert len({(r["payload_sha256"], r["feature"], r["media_sha256"]) for r in found}) == len({r["payload_sha256"] for r in found})


def test_packing(spark, rows):
    found = collect(packing.pack(packing.pieces(frame(spark, rows), catalog.TOKENIZER)))
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, text, *_ in rows:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(i, n, 4096 * n, len(p), zlib.crc32(p.tobytes())) for n, p in enumerate(np.split(ids, range(4096, len(ids), 4096)))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == sorted(want)
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        assert sum(n for _, n in b) <= 4096 and [o for o, _ in sorted(b)] == list(np.cumsum([0, *[n for _, n in sorted(b)]])[:-1])
    assert len(bins) <= -(-sum(w[3] for w in want) // 4096) + 1


def test_packing_plan_at_most_two_large_items():
    rng = random.Random(2)
    for _ in range(40):
        histogram = {rng.randint(1, 4096): rng.randint(1, 60) for _ in range(rng.choice([1, 20, 400]))}
        held = {}
        for b in packing.plan(dict(histogram), 4096):
            assert b.gap >= 0 and sum(k for n, k, _ in b.items if 3 * n > 4096) <= 2
            for n, k, _ in b.items:
                held[n] = held.get(n, 0) + k * b.count
        assert held == histogram


def test_quality(spark, rows):
    for r, row in zip(sorted(collect(quality.judge(frame(spark, rows))), key=lambda x: (x["doc_id"], x["n_words"])), sorted(rows, key=lambda x: x[0])):
        text = row[1] or ""
        words = WORD.findall(text)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)} if len(words) < 500 else set(range(len(words)))
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), len(inside))
        assert r["base_failed"] == (len(words) < 20 or 100 * len(inside) > 30 * len(words)) and not (r["base_failed"] and r["kept"])
    slow_first = quality.ordered(quality.RULES, [(x.name, 1.0, 0.1 * i) for i, x in enumerate(quality.RULES)])
    assert [x.name for x in slow_first] == [x.name for x in reversed(quality.RULES)]


@pytest.mark.parametrize("n,percent,small", [(4, 85, 12), (5, 80, 1), (2, 60, 2)])
def test_jaccard(spark, rows, n, percent, small):
    got = collect(jaccard.links_and_groups(frame(spark, rows), n=n, percent=percent, small=small, family_members=300))
    sets = {}
    for i, text, *_ in rows:
        w = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted((r[0], len(sets[r[0]]), find(r[0])) for r in rows)


def test_one_of_each_row(spark):
    rng = random.Random(8)
    a, b, c, d, e, f = (" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(40)) for _ in range(6))
    near = c + " more"
    rows = [(1, a), (1, b), (None, a), (None, c), (None, c), (None, near), (None, ""), (5, d), (5, d), (None, e), (7, f), (8, f), (8, a.upper())]
    got = collect(jaccard.one_of_each(frame(spark, [(i, t, None, None, 0) for i, t in rows])))
    found = sorted((r["doc_id"] or 0, "c" if r["text"] in (c, near) else r["text"]) for r in got)
    assert found == sorted([(1, a), (1, b), (0, "c"), (0, ""), (5, d), (0, e), (7, f)])


def test_substring(spark, rows):
    got = collect(substring.cut_repeats(frame(spark, rows), width=20, bucket_rows=7))
    first = {}
    docs = sorted({(i, text or "") for i, text, *_ in rows})
    for i, text in docs:
        w = WORD.findall(text)
        for s in range(len(w) - 19):
            first.setdefault(tuple(w[s : s + 20]), (i, s))
    want = {}
    for i, text in docs:
        w = WORD.findall(text)
        gone = {j for s in range(len(w) - 19) if first[tuple(w[s : s + 20])] != (i, s) for j in range(s, s + 20)}
        want[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    assert len(got) == len(rows) and all(want[r["doc_id"]] == (r["n_words"], r["n_removed"], r["kept_text"]) for r in got)


def test_substring_rows_of_one_id(spark):
    rng = random.Random(6)
    words = lambda n: ["".join(rng.choices("abcdefgh", k=7)) for _ in range(n)]
    passage, copied, short = words(30), words(50), words(60)
    early, late, far, other = words(400), words(40), words(500), words(25)
    rows = [
        (1, passage + copied), (2, copied),
        (None, copied), (None, early + passage), (None, late), (None, short), (None, short),  # a copy, a late passage, two that lose nothing
        (7, far + passage), (7, other), (7, copied), (7, passage[:25] + late[:5]), (8, late + words(3)),
    ]
    want = [passage + copied, [], [], early, late[:0], short, short, far, other, [], late[:5], late + rows[-1][1][40:]]
    for bucket_rows in (1, 400):
        got = collect(substring.cut_repeats(frame(spark, [(i, " ".join(w), None, None, 0) for i, w in rows]), width=20, bucket_rows=bucket_rows))
        assert sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == sorted((i or -1, len(w), len(w) - len(k), " ".join(k)) for (i, w), k in zip(rows, want))
    # equal starts in two texts of one id: the passage stays once
    two = collect(substring.cut_repeats(frame(spark, [(i, " ".join(passage + rest), None, None, 0) for i in (3, None) for rest in (late, other)]), width=20))
    assert sorted(r["kept_text"].startswith(passage[0]) for r in two) == [False] * 3 + [True] and sum(r["n_removed"] == 30 for r in two) == 1


def test_mixing_and_sharding(spark, rows):
    docs = frame(spark, rows)
    got = collect(mixing.rates(docs.drop("size")))
    by = {r["source"]: r["target"] for r in got}
    total = sum(len(WORD.findall(r[1] or "")) for r in rows)
    assert abs(sum(by.values()) - 1.5 * total) < 1e-6 and all(r["target"] <= 2 * r["source_size"] and r["copies"] <= 2 for r in got)
    assert sorted(map(str, got)) == sorted(map(str, collect(mixing.rates(docs.drop("size")))))
    placed = collect(sharding.interleave(docs, bucket_rows=10))
    counts = [sum(r["shard"] == s for r in placed) for s in range(8)]
    assert max(counts) - min(counts) <= 1 and all(sorted(r["slot"] for r in placed if r["shard"] == s) == list(range(n)) for s, n in enumerate(counts))


def test_html():
    page = '<html><head><title>x</title></head><body><nav><a href=1>m</a></nav><div class="cookie-notice">we use</div><article><h1>T &amp; U</h1><p>One <b>two\n three</b> four.<p>Five &lt;six&gt;<br>seven</article><aside>side</aside><section id="comments"><p>me too, long comment text here</p></section><footer>f</footer>'
    assert html.main_text(page) == "T & U\nOne two three four.\nFive <six> seven"
    assert html.main_text("") == "" and html.main_text("just text") == "just text" and html.main_text("<p") is not None


@pytest.mark.parametrize("name", ["container has-sidebar", "content no-sidebar", "page-with-toc", "related", "search", "side", "skip", "notice", "banner", "sidebar-layout", "menu open", "comments-open"])
def test_html_name_of_the_wrapper(name):
    paragraphs = [f"Paragraph {i} of the article says a good deal about its matter, and at length." for i in range(6)]
    menu = "".join(f"<a href={i}>menu item {i}</a>" for i in range(5))
    inner = "".join(f"<p>{p}</p>" for p in paragraphs)
    for page in (f'<body><div class="{name}"><div>{inner}</div></div></body>', f'<body><div class="nav">{menu}</div><div class="{name}"><div id="sidebar">{menu} and more</div><div>{inner}</div><div class="ad">buy this now</div></div></body>'):
        assert html.main_text(page) == "\n".join(paragraphs)


def test_html_advert_longer_than_the_article():
    assert html.main_text('<body><div class="ad">An advert that says more than the article below it.</div><article><h1>Title</h1><p>Short.</article></body>') == "Title\nShort."


def test_html_keeps_what_lies_in_the_article():
    inner = "".join(f"<p>Paragraph {i} of the article says a good deal about its matter.</p>" for i in range(4))
    links = "<ul>" + "".join(f"<li><a href={i}>Source number {i}</a></li>" for i in range(4)) + "</ul>"
    long = "".join(f"<li>Reader {i} writes a reply that is longer than anything in the article, over and over again.</li>" for i in range(9))
    page = f'<body><ul><li><a>m1</a><li><a>m2</a><li><a>m3</a></ul><div class="banner">site banner text</div><article><h1>Title</h1>{inner}<div class="notice">Mind this.</div>{links}<div class="share">share it</div></article><div id="comments"><ol>{long}</ol></div></body>'
    got = html.main_text(page)
    assert got.split("\n")[0] == "Title" and got.split("\n")[5:] == ["Mind this.", *(f"Source number {i}" for i in range(4))] and len(got.split("\n")) == 10


def test_licenses(spark):
    rng = random.Random(3)
    noise = lambda n: " ".join("".join(rng.choices("abcdefg", k=4)) for _ in range(n))
    rows = [(i, f"{noise(rng.randint(0, 900))} {text} {noise(rng.randint(0, 300))}", None, None, 0) for i, text in enumerate(TEMPLATES.values())] + [(90, None, None, None, 0), (91, "", None, None, 0), (92, noise(5000) + " license", None, None, 0)]
    got = {(r["doc_id"], r["template"]) for r in collect(licenses.scan(frame(spark, rows)))}
    want = set()
    for i, text, *_ in rows:
        grams = lambda t: {tuple(licenses._words(t)[j : j + 3]) for j in range(len(licenses._words(t)) - 2)}
        want |= {(i, name) for name, t in TEMPLATES.items() if text and len(grams(t) & grams(text)) >= 0.8 * len(grams(t))}
    assert got == want


def test_licenses_of_other_wordings(spark):
    texts = {
        "mit-licensed-line": "Licensed under the MIT License", "spdx-mit": "// SPDX-License-Identifier: MIT", "spdx-gpl-3.0": "SPDX-License-Identifier: GPL-3.0-or-later",
        "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0", "gpl-2.0-line": "under the GNU General Public License, version 2", "lgpl-line": "Licensed under the GNU Lesser General Public License",
        "agpl-line": "Licensed under the GNU Affero General Public License", "isc-line": "Licensed under the ISC License", "mit-disclaimer": ALL["mit-disclaimer"],
        "bsd-disclaimer": ALL["bsd-disclaimer"], "unlicense": ALL["unlicense"],
    }
    got = collect(licenses.scan(frame(spark, [(i, f"some words {t} and others", None, None, 0) for i, t in enumerate(texts.values())]), templates=ALL))
    assert {(r["doc_id"], r["template"]) for r in got} == set(enumerate(texts))


def test_toxicity(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        words = ["".join(rng.choices(["ba", "lo", "ti", "ren"], k=3)) for _ in range(40)]
        if i % 3 == 0:
            words[rng.randrange(40)] = words[rng.randrange(40)] = "xugglo"
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, int(i % 3 == 0)))
    rows += [(1000, None, None, None, None), (1001, "", None, None, 0)]
    got = collect(toxicity.score(frame(spark, rows), spark.createDataFrame([*labels, (5000, None)], "doc_id long, toxic int")))
    assert len(got) == 402 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 400]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert sum(r["predicted"] == (r["doc_id"] % 3 == 0) for r in held) > 0.9 * len(held)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] >= 1000)


def test_pipeline_stages(spark, rows):
    docs = frame(spark, rows).select(*corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.quality_rules(spark, docs, "")
    assert kept.columns == list(corpus_pipeline.COLUMNS) and 0 < kept.count() < docs.count()
    once = corpus_pipeline.ngram_jaccard(spark, kept, "")
    groups = jaccard.links_and_groups(kept, n=5, percent=80)
    assert once.count() == groups.select("component_id").distinct().count()
    cut = corpus_pipeline.substring_dedup(spark, once, "")
    assert cut.count() == once.count() and cut.columns == list(corpus_pipeline.COLUMNS)
    mix = corpus_pipeline.mixing_sources(spark, cut, "")
    packed = corpus_pipeline.best_fit_packing(spark, mix, "")
    assert packed.filter("start = 0").count() == mix.count()


def test_pipeline_run_equals_plain_python(spark, rows, tmp_path):
    frame(spark, rows).select(*corpus_pipeline.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    got = collect(corpus_pipeline.run(spark, str(tmp_path)))

    def passes(text):
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        often = {w for w, k in Counter(windows).items() if k > 1}
        inside = {j for i, w in enumerate(windows) if w in often for j in range(i, i + 8)}
        letters = [c for c in text if c.isalpha()]
        base = len(words) >= 20 and 100 * len(inside) <= 30 * len(words)
        return base and 10 * sum(c in "#*$%&|<>" for c in text) <= len(words) and 2 * len(words) <= sum(map(len, words)) <= 14 * len(words) and 2 * (len(lines) - len(set(lines))) <= len(lines) and 2 * sum(c.isupper() for c in letters) <= len(letters) and 4 * sum(any(c.isalpha() for c in w) for w in words) >= 3 * len(words)

    docs = [(i, text, source) for i, text, _, source, _ in rows if passes(text or "")]
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, text, _ in docs for w in [text.lower().split()]}
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    docs = [d for d in docs if find(d[0]) == d[0]]
    assert len(docs) < len(sets)

    first, cut = {}, []
    for i, text, source in sorted(docs):
        w = WORD.findall(text)
        gone = set()
        for s in range(len(w) - 19):
            if first.setdefault(tuple(w[s : s + 20]), (i, s)) != (i, s):
                gone |= set(range(s, s + 20))
        cut.append((i, " ".join(x for j, x in enumerate(w) if j not in gone) if gone else text, source))
    assert any(a[1] != b[1] for a, b in zip(sorted(docs), cut))

    size = Counter()
    for _, text, source in cut:
        size[source] += len(WORD.findall(text))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(size))}
    target, left = {}, Fraction(3, 2) * sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in size if x not in target) for s in size if s not in target}
        full = [s for s in share if share[s] >= 2 * size[s]]
        if not full:
            target |= share
            break
        target |= {s: 2 * size[s] for s in full}
        left -= sum(2 * size[s] for s in full)
    want = Counter()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, text, source in cut:
        rate = Fraction(target[source]) / size[source]
        coin = int(hashlib.md5(f"{i}:mix".encode()).hexdigest()[:8], 16) / 2**32
        ids = np.array(tok.encode(text, add_special_tokens=False).ids + [1], "<u4")
        for n, p in enumerate(np.split(ids, range(4096, len(ids), 4096))):
            want[i, n, 4096 * n, len(p), zlib.crc32(p.tobytes())] += int(rate) + (coin < rate - int(rate))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == +want
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        assert sum(n for _, n in b) <= 4096 and [o for o, _ in sorted(b)] == list(np.cumsum([0, *[n for _, n in sorted(b)]])[:-1])
