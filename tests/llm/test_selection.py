"""Language, mix, shards, quality and licences."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from checks.compare import duck, rows_of
from evenhand.llm import language, licenses, mixing, quality, shards
from evenhand.llm.license_texts import BSD_3, ISC, MIT
from evenhand.llm.statements import LICENSES_SQL, MIXING_SQL
from tests.llm import brute

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(documents):
    model = language.fit(documents)
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    rows = language.predict(documents, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_unseen_words_fall_back():
    counts = [(0, "le", {"fr": 9}), (0, "the", {"en": 9}), (1, "e", {"en": 5, "fr": 5}), (2, "th", {"en": 9}), (2, "le", {"fr": 9})]
    model = language.Model(["en", "fr"], counts)
    assert language.Reader(model).read("thx")[0] == "en"
    assert language.Reader(model).read("xle le")[0] == "fr"
    assert language.Reader(model).read("123 !") == ("und", 0.0)
    assert language.Reader(language.Model([], [])).read("word") == ("und", 0.0)


def test_language_of_odd_rows(odd, odd_rows, nothing):
    model = language.fit(odd)
    rows = language.predict(odd, model).collect()
    assert len(rows) == len(odd_rows)
    blank = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {0, 1, 2} <= blank and 3 not in blank
    kept = language.keep_known(odd, model)
    assert kept.columns == odd.columns and not {r.doc_id for r in kept.collect()} & {0, 1, 2}
    assert language.predict(nothing, language.fit(nothing)).collect() == []
    assert language.keep_known(nothing, language.fit(nothing)).collect() == []


def test_mix_reaches_its_targets(documents):
    rows = mixing.mix(documents).collect()
    taken, target, size, largest = Counter(), {}, {}, Counter()
    source = {r.doc_id: r.source for r in documents.select("doc_id", "source").collect()}
    for r in rows:
        name = source[r.doc_id]
        taken[name] += r.taken
        target[name], size[name] = r.target, r.source_size
        largest[name] = max(largest[name], r.size)
        assert 0 <= r.taken <= 2 * r.size
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6 * sum(size.values())
    for name in target:
        assert target[name] <= 2 * size[name] and abs(taken[name] - target[name]) <= largest[name]
    assert sorted(map(tuple, mixing.mix(documents).collect())) == sorted(map(tuple, rows))


def test_targets_by_rounds_of_resharing(spark):
    sizes = {"a": 10, "b": 1000, "c": 50, "d": 0, "e": 400, None: 70}
    names = [*sorted(n for n in sizes if n), None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    expected, free, rest = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        share = {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n for n in free if share[n] > 2 * sizes[n]}
        if not over:
            break
        for n in over:
            expected[n] = 2 * sizes[n]
            rest -= 2 * sizes[n]
        free -= over
    expected |= share
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(table, (5, 2, 1), 1.5, 2.0).collect()}
    assert found == pytest.approx(expected)


def test_inclusion_follows_the_odds(spark):
    """Over many seeds documents are included as often as their probability says, long ones more often than short ones."""
    rnd = random.Random(9)
    rows = [(i, " ".join(["w"] * rnd.choice([3, 10, 40])), "ab"[i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").persist()
    _, planned = mixing.plan(docs, total_share=0.7, max_repeats=1.5)
    plans = {r.source: r for r in planned.collect()}
    taken, seeds = defaultdict(Counter), 8
    for seed in range(seeds):
        for r in mixing.mix(docs, total_share=0.7, max_repeats=1.5, seed=f"s{seed}").collect():
            source = "ab"[r.doc_id % 2]
            is_long = r.size >= plans[source].source_size / plans[source].docs
            taken[source, is_long]["docs"] += 1
            taken[source, is_long]["extra"] += r.taken // r.size - plans[source].whole
    for (source, is_long), seen in taken.items():
        p = plans[source].p_long if is_long else plans[source].p_short
        assert abs(seen["extra"] / seen["docs"] - p) < 0.06, (source, is_long, seen, p)
    assert all(p.p_long - p.p_short > 0.1 for p in plans.values() if 0.2 < p.target / p.source_size % 1 < 0.8)
    docs.unpersist()


def test_quotient_orders_like_odds_over_odds(spark):
    rows = [(u / 50, p / 10) for u in range(50) for p in range(11)]
    found = spark.createDataFrame(rows, "u double, p double").select("u", "p", mixing.quotient(F.col("u"), F.col("p")).alias("t")).collect()
    inner = [((r.u / (1 - r.u)) / (r.p / (1 - r.p)), r.t) for r in found if 0 < r.p < 1]
    assert all(t == pytest.approx(q / (1 + q)) for q, t in inner)
    assert all(r.t == r.u for r in found if r.p in (0, 1))


def test_mix_of_odd_rows(odd, odd_rows, nothing):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(odd_rows)
    by_size = Counter(r.size for r in rows)
    assert by_size == Counter(len(brute.words(r[1])) for r in odd_rows)
    repeated = Counter()
    for r in rows:
        if r.size:
            repeated[r.doc_id] += r.taken // r.size
    copies = mixing.mixed(odd)
    assert copies.columns == odd.columns
    counted = Counter(r.doc_id for r in copies.collect() if brute.words(r.text))
    assert counted == +repeated
    assert mixing.mix(nothing).collect() == [] and mixing.mixed(nothing).collect() == []


@pytest.mark.parametrize("statement", [MIXING_SQL, LICENSES_SQL])
def test_statements(spark, statement):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mine = mixing.mix(docs) if statement is MIXING_SQL else licenses.scan(docs)
    result = duck(sf).execute(statement)
    assert rows_of(mine.columns, mine.collect()) == rows_of([d[0] for d in result.description], result.fetchall())


def test_shards_are_even_gapless_and_keep_copies(documents):
    rows = shards.assign(documents).collect()
    sizes, slots, homes = Counter(), defaultdict(list), defaultdict(set)
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        homes[data].add(r.shard)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())


def test_shards_of_odd_rows(odd, odd_rows, nothing):
    rows = shards.assign(odd).collect()
    assert Counter(r.size for r in rows) == Counter(len((t or "").encode()) + 1 for _, t, *_ in odd_rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shards.assign(nothing).collect() == []
    assert {r.shard for r in shards.assign(odd, 3).collect()} <= {0, 1, 2}


def test_quality_counts(odd, odd_rows, nothing):
    rows = quality.judge(odd, MODEL).collect()
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = brute.ordered([tuple(r[n] for n in names) for r in rows])
    assert found == brute.ordered([(d, *brute.quality_counts(t)) for d, t, *_ in odd_rows])
    assert not any(r.kept and r.base_failed for r in rows)
    assert quality.judge(nothing, MODEL).collect() == []


def test_fertility_bands(spark):
    texts = [
        (1, "The people of the town walked along the river and talked about the weather for a long time that evening. " * 2, "en"),
        (2, " ".join(chr(0x16A0 + i % 70) * 3 for i in range(60)), "en"),  # letters that the vocabulary spells in bytes
        (3, " ".join(chr(0x4E00 + 7 * i) for i in range(120)), None),
        (4, "Les gens de la ville marchaient le long de la rivière et parlaient du temps qu'il faisait ce soir-là dans le pays.", "xx"),
    ]
    rows = {r.doc_id: r for r in quality.judge(spark.createDataFrame(texts, "doc_id long, text string, lang string"), MODEL).collect()}
    assert rows[1].chars_per_token > 3 and rows[4].kept and rows[3].kept
    assert rows[2].byte_share > 0.5 and not rows[2].base_failed and not rows[2].kept


def test_clean_documents_are_kept(documents):
    rows = quality.judge(documents, MODEL).collect()
    assert sum(r.kept for r in rows) >= 0.99 * sum(not r.base_failed for r in rows)


def test_a_rare_language_is_learned(spark, documents):
    rnd = random.Random(5)
    rare = ["".join(rnd.choice("kwzxqj") + rnd.choice("aiou") for _ in range(rnd.randint(1, 4))) for _ in range(300)]
    rows = [(10**6 + i, " ".join(rnd.choices(rare, k=60)), "rare") for i in range(12)]
    docs = documents.select("doc_id", "text", "lang").union(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    model = language.fit(docs, max_docs=60, max_words=300, max_grams=600)
    found = language.predict(docs, model).collect()
    assert model.languages == ["de", "en", "es", "fr", "rare"]
    assert all(r.lang_pred == "rare" for r in found if r.doc_id >= 10**6)
    assert sum(len(t) for t in model.tables) <= 900 and len([w for w in rare if w in model.tables[0]]) >= 55
    assert sum(r.lang_pred == "rare" for r in found if r.doc_id < 10**6) == 0
    assert language.sample_level([5, 100, 1000], 300) == 195 and language.sample_level([3, 4], 10) == 4 and language.sample_level([], 9) == 0


def invented_junk() -> dict[str, str]:
    rnd = random.Random(7)
    made = lambda letters: " ".join("".join(rnd.choices(letters, k=rnd.randint(3, 9))) for _ in range(150))
    return {
        "hex": "\n".join(hashlib.sha256(rnd.randbytes(9)).hexdigest() for _ in range(15)),
        "base64": "\n".join(base64.b64encode(rnd.randbytes(45)).decode() for _ in range(15)),
        "letters": made(string.ascii_lowercase), "consonants": made("bcdfghjklmnpqrstvwxz"),
        "single letters": " ".join(rnd.choices(string.ascii_lowercase, k=150)),
        "numbers": " ".join(str(rnd.randrange(10**9)) for _ in range(60)),
    }


@pytest.mark.parametrize("with_corpus", [False, True])
def test_junk_is_rejected(spark, documents, with_corpus):
    langs = ["en", "de", "es", "fr"]
    rows = [(10**6 + i, text, lang) for i, (text, lang) in enumerate((t, lang) for t in invented_junk().values() for lang in langs)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    if with_corpus:
        docs = docs.union(documents.select("doc_id", "text", "lang"))
    found = {r.doc_id: r for r in quality.judge(docs, MODEL).collect()}
    assert [(t, lang) for d, t, lang in rows if found[d].base_failed or found[d].kept] == []


def test_shouted_text_is_rejected_and_prose_stays(documents):
    prose = documents.select("doc_id", "text", "lang").join(
        quality.judge(documents, MODEL).filter("NOT base_failed AND n_tokens >= 100").select("doc_id"), "doc_id"
    )
    loud = prose.filter("doc_id % 10 = 0").selectExpr("doc_id + 1000000 AS doc_id", "regexp_replace(upper(text), '([^ \\n]+)', '$1!!') AS text", "lang")
    rows = quality.judge(prose.union(loud), MODEL).filter("NOT base_failed").collect()
    shouted = [r for r in rows if r.doc_id >= 10**6]
    calm = [r for r in rows if r.doc_id < 10**6]
    assert len(shouted) >= 50 and sum(r.kept for r in shouted) <= 0.02 * len(shouted)
    assert sum(r.kept for r in calm) >= 0.99 * len(calm)


def test_bands_do_not_depend_on_parts(documents):
    some = documents.filter("doc_id % 2 = 0")
    assert brute.ordered(quality.judge(some.repartition(7), MODEL).collect()) == brute.ordered(quality.judge(some.coalesce(1), MODEL).collect())


def test_licences(spark, odd, odd_rows, nothing):
    texts = [
        (1, "Copyright (c) 2020 Some One\n\n" + MIT), (2, MIT.upper().replace("\n", "  \r\n ")), (3, "// (C) 1999 X\nISC Licence\n\n" + ISC),
        (4, MIT + " and more"), (5, BSD_3.replace("unauthorized", "unauthorised")), (6, "words\nLicenced under the apache license version 2.0\nwords\nReleased under the MIT License."),
        (7, None), (8, ""), (8, ""), (9, "Copyright 2020 Nobody"),
    ]
    rows = brute.ordered(licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).select("doc_id", "licence", "n_notices", "notices").collect())
    assert rows == brute.ordered([
        (1, "MIT", 0, None), (2, "MIT", 0, None), (3, "ISC", 0, None), (4, None, 0, None), (5, "BSD-3-Clause", 0, None), (6, None, 2, "Apache-2.0,MIT"),
        (7, None, 0, None), (8, None, 0, None), (8, None, 0, None), (9, None, 0, None),
    ])
    assert len(licenses.scan(odd).collect()) == len(odd_rows) and licenses.scan(nothing).collect() == []


def test_long_licences_and_their_statement(spark):
    from evenhand.llm import license_texts

    whole = license_texts.FILES
    apache, gpl = whole["Apache-2.0"], whole["GPL-2.0"]
    rows = [(i, text, name) for i, (name, text) in enumerate(whole.items())]
    rows += [
        (100, apache[: apache.index("APPENDIX")].strip().upper(), "Apache-2.0"), (101, gpl[: gpl.index("How to Apply")].replace("\n", " \r\n"), "GPL-2.0"),
        (102, gpl.replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA"), "GPL-2.0"),
        (103, whole["GPL-3.0"].replace("https://", "http://"), "GPL-3.0"), (104, apache + " and more", None), (105, gpl[:9000], None),
        (106, "# Copyright 2020 Some One\n#\n" + "".join(f"# {line.strip()}\n" for line in apache[apache.index("Licensed under the Apache") :].splitlines()), "Apache-2.0"),
        (107, "// SPDX-License-Identifier: GPL-3.0-or-later\nwords\nReleased under the Mozilla Public Licence, version 2.0.", None),
    ]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert {d: found[d].licence for d, *_ in rows} == {d: name for d, _, name in rows}
    assert (found[107].n_notices, found[107].notices) == (2, "GPL-3.0-or-later,MPL-2.0")
    con = duck("/root/testdata/sf0.001")
    con.execute("CREATE OR REPLACE TEMP TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    stated = {r[0]: (r[1], r[2]) for r in con.execute(LICENSES_SQL).fetchall()}
    assert stated == {d: (r.digest, r.licence) for d, r in found.items()}


def test_letters_alone_make_words():
    assert language.words_of("²  ½ ① Ⅷ 12 a1b") == ["a", "b"]
    assert language.words_of("Été ÉTÉ日本 x²y") == ["été", "été日本", "x", "y"]
    model = language.Model(["en", "fr"], [(0, "a", {"en": 9})])
    assert language.Reader(model).read("²  ½") == ("und", 0.0)


def brute_language(rows):
    """lang_pred and score of every text, from a model that counts and averages one word at a time."""
    learned = [(t, lang) for d, t, lang in rows if d is not None and lang is not None and zlib.crc32(str(d).encode()) % 4 != 2]
    counts = defaultdict(lambda: defaultdict(int))
    for text, lang in learned:
        for word in language.words_of(text):
            counts[0, word][lang] += 1
            for n in range(1, 5):
                marked = f"^{word}$"
                for i in range(max(1, len(marked) - n + 1)):
                    counts[n, marked[i : i + n]][lang] += 1
    languages = sorted({lang for by in counts.values() for lang in by})
    totals, kinds = defaultdict(lambda: defaultdict(int)), Counter(n for n, _ in counts)
    for (n, _), by in counts.items():
        for lang, c in by.items():
            totals[n][lang] += c

    def logs(key):
        return [math.log((counts[key].get(x, 0) + 0.5) / (totals[key[0]][x] + 0.5 * kinds[key[0]])) for x in languages]

    def of_word(word):
        if (0, word) in counts:
            return logs((0, word))
        for n in (4, 3, 2, 1):
            marked = f"^{word}$"
            known = [(n, marked[i : i + n]) for i in range(max(1, len(marked) - n + 1)) if (n, marked[i : i + n]) in counts]
            if known:
                return [sum(col) / len(known) for col in zip(*map(logs, known))]
        return [0.0] * len(languages)

    out = []
    for _, text, _ in rows:
        words = language.words_of(text)
        if not words or not languages:
            out.append(("und", 0.0))
            continue
        mean = [sum(col) / len(words) for col in zip(*map(of_word, words))]
        best = max(range(len(languages)), key=lambda i: (mean[i], -i))
        out.append((languages[best], 1 / sum(math.exp((m - mean[best]) * min(len(words), 8)) for m in mean)))
    return out


def test_language_equals_its_definition(spark):
    rnd = random.Random(21)
    stock = {lang: ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 6))) for _ in range(60)] for lang, letters in
             {"en": "thesand", "fr": "lesdéau", "de": "dießenu", "und": "xyz"}.items()}
    rows = [(i, " ".join(rnd.choice(stock[lang] + stock["en"]) for _ in range(rnd.randint(0, 12))), lang if i % 5 else None)
            for i in range(150) for lang in [rnd.choice(list(stock))]]
    rows += [(500, "qqq unseen thes ²", None), (501, None, "en"), (None, "the sand", "fr"), (502, "12 ½", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for limits in ({}, {"max_words": None, "max_grams": None}):
        found = language.predict(docs, language.fit(docs, **limits)).collect()
        assert len(found) == len(rows)
        expected = Counter((d, *answer) for (d, _, _), answer in zip(rows, brute_language(rows)))
        for r in found:
            near = [k for k in expected if k[0] == r.doc_id and k[1] == r.lang_pred and abs(k[2] - r.score) < 1e-5]
            assert near, r


def test_no_vocabulary_is_lost_without_limits(documents):
    model = language.fit(documents, max_words=None, max_grams=None)
    small = language.fit(documents, max_words=100, max_grams=100)
    assert len(small.tables[0]) == 100 and len(model.tables[0]) > 10_000
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    held = [r for r in language.predict(documents, model).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def kd_tree(points, shards):
    """Shard of each (weight, dimensions, digest) point: nodes are split at weighted medians, in plain Python."""
    ends = [(min(p[1][d] for p in points), max(p[1][d] for p in points)) for d in range(4)]
    scaled = [(w, [(x - low) / ((high - low) or 1.0) for x, (low, high) in zip(dims, ends)], digest) for w, dims, digest in points]
    leaf = {}

    def split(members, first, n):
        if n == 1 or not members:
            leaf.update(dict.fromkeys(members, first))
            return
        widths = [max(scaled[i][1][d] for i in members) - min(scaled[i][1][d] for i in members) for d in range(4)]
        widest = widths.index(max(widths))

        def order(i):
            return math.floor(scaled[i][1][widest] * (2**28 - 1)) * 2**20 + int(scaled[i][2][:5] or "0", 16)

        goal, before = sum(scaled[i][0] for i in members) * (n // 2) / n, 0
        weights = Counter()
        for i in members:
            weights[order(i)] += scaled[i][0]
        for value in sorted(weights):
            if before + weights[value] > goal:
                cut = value + (goal - before >= weights[value] / 2)
                break
            before += weights[value]
        split([i for i in members if order(i) < cut], first, n // 2)
        split([i for i in members if order(i) >= cut], first + n // 2, n - n // 2)

    split(list(range(len(points))), 0, shards)
    return leaf


@pytest.mark.parametrize("n_shards", [2, 5, 8])
def test_shards_are_those_of_a_plain_tree(spark, n_shards):
    rnd = random.Random(31)
    rows = []
    for i in range(400):
        text = " ".join(rnd.choice(["lorem", "ipsum", "dolor"]) for _ in range(rnd.choice([1, 5, 30, 200])))
        rows.append((i * 7 % 400, text if i % 50 else None, rnd.choice(["en", "fr", None]), f"common-prefix-{rnd.randint(0, 6)}"))
    rows += [(1000 + i, rows[3][1], "en", "common-prefix-1") for i in range(30)]
    ranks = [{v: float(n) for n, v in enumerate(sorted({r[c] for r in rows if r[c] is not None}), 1)} for c in (2, 3)]
    groups = defaultdict(list)
    for doc_id, text, lang, source in rows:
        size = len((text or "").encode()) + 1
        digest = hashlib.sha256(text.encode()).hexdigest() if text is not None else ""
        dims = (ranks[0].get(lang, 0.0), ranks[1].get(source, 0.0), math.log(size) / math.log(2), float(doc_id))
        groups[digest].append((doc_id, dims, size))
    points = [(sum(m[2] for m in members), min(members, key=lambda m: (m[0], m[1]))[1], digest) for digest, members in groups.items()]
    expected = {points[i][2]: shard for i, shard in kd_tree(points, n_shards).items()}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    found = {r.doc_id: r.shard for r in shards.assign(docs, n_shards).collect()}
    assert found == {m[0]: expected[digest] for digest, members in groups.items() for m in members}


def test_fertility_verdicts_follow_from_the_quartiles(documents):
    with open(MODEL, "rb") as file:
        table = quality.words_table(file.read())
    rows = documents.select("doc_id", "text", "lang").collect()
    names = list(quality.COLUMNS)
    seen = {r.doc_id: dict(zip(names, quality.measure(table, r.text, r.lang))) for r in rows}
    values = defaultdict(list)
    keys = ("band", "n_words", "word_chars", "n_tokens", "entropy", "chars_per_token", "case")
    for key in {tuple(m[k] for k in keys) for m in seen.values() if m["band"] is not None}:
        m = dict(zip(keys, key))
        for name in quality.LEAST_SPREAD:
            if m[name] is not None and (name != "entropy" or m["n_tokens"] >= quality.LEAST_TOKENS_ENTROPY):
                values[m["band"], name].append(round(m[name], 3))
    reach = {}
    for (band, name), of_band in values.items():
        if len(of_band) >= quality.LEAST_DOCUMENTS:
            low, high = np.percentile(of_band, [25, 75])
            away = quality.FENCE * max(high - low, quality.LEAST_SPREAD[name] * low)
            reach[band, name] = high + away if name == "case" else low - away
    assert len({band for band, _ in reach}) == 4

    def kept(m):
        if m["base_failed"] or m["band"] is None:
            return not m["base_failed"]
        (least, most), most_bytes, least_entropy = quality.BANDS[m["band"]]
        least, least_entropy = max(least, reach.get((m["band"], "chars_per_token"), least)), max(least_entropy, reach.get((m["band"], "entropy"), least_entropy))
        most_case = min(quality.MOST_CASE, reach.get((m["band"], "case"), quality.MOST_CASE))
        return least <= m["chars_per_token"] <= most and m["byte_share"] <= most_bytes and m["case"] <= most_case and (
            m["n_tokens"] < quality.LEAST_TOKENS_ENTROPY or m["entropy"] >= least_entropy)

    found = {r.doc_id: r.kept for r in quality.judge(documents, MODEL).collect()}
    assert found == {d: kept(m) for d, m in seen.items()}
    assert len(set(found.values())) == 2
