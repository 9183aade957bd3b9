"""Training-data operators against brute force on small invented and given rows."""
import base64
import hashlib
import io
import os
import re
import sys
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import SF_SMALL  # noqa: E402

from revlens.llm import (decontaminate, language_id, licenses, mixing, ngram_join, queries, substring_dedup,  # noqa: E402
                         token_counts, toxicity, weak_supervision, zip_warc)
from revlens.llm import _text as T  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}x" for i in range(400)]


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    queries.prepare(spark)


def words(seed, n):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


def frame(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, None if t is None else len(t)) for i, t in texts], DOCS)


def test_components_match_brute_force(spark):
    base = words(1, 120)
    texts = [(1, base), (2, base), (3, base.replace("w1x", "changed")), (4, base + " tail"), (5, None), (6, ""), (7, "one two"),
             (8, "ONE two"), (9, words(2, 60)), (9, words(2, 60)), (10, base[60:]), (11, " \t ")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(frame(spark, texts)).collect()}
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(w[j:j + 4]) for j in range(len(w) - 3)} or ({tuple(w)} if w else set())
    comp = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    assert got == {i: (len(s), comp[i]) for i, s in sets.items()}


def test_empty_tables(spark):
    none = frame(spark, [])
    assert ngram_join.near_duplicates(none).count() == 0
    assert substring_dedup.repeated_passages(none).count() == 0
    assert mixing.taken_words(none).count() == 0
    assert weak_supervision.judge(none).count() == 0
    assert licenses.find_licenses(none).count() == 0


def test_passage_is_cut_from_later_documents_only(spark):
    shared = words(5, 60)
    texts = [(1, words(6, 40) + " " + shared), (2, "Ünï " + words(7, 30) + " " + shared + " " + words(8, 30)), (3, words(9, 80)), (4, None)]
    docs = frame(spark, texts)
    found = substring_dedup.repeated_passages(docs)
    rows = found.collect()
    assert {r.doc_id for r in rows} == {2} and {r.first_doc_id for r in rows} == {1}
    assert all(texts[1][1][r.start:r.end] in shared for r in rows)
    out = {r.doc_id: r for r in substring_dedup.cut_passages(docs, found).collect()}
    assert out[1].text == texts[0][1] and out[3].text == texts[2][1] and out[4].text is None
    assert shared not in out[2].text and out[2].n_chars == len(out[2].text) < len(texts[1][1])


def test_copies_of_10_to_40_words_are_found_in_any_order(spark):
    copied = [words(700 + n, n) for n in range(10, 41)]
    texts = [(i, t) for i, t in enumerate(copied)] + [(100 + i, "\n " + t.upper().replace(" ", "  ")) for i, t in enumerate(copied)]
    texts += [(200 + i, words(800 + i, 10 + i)) for i in range(30)] + [(300, "ok"), (301, "OK"), (302, "single")]
    expected = {(100 + i, i, 2, len(texts[len(copied) + i][1]), 10 + i) for i in range(len(copied))} | {(301, 300, 0, 2, 1)}
    for seed, parts in ((1, 1), (2, 3), (3, 7)):
        order = np.random.default_rng(seed).permutation(len(texts))
        docs = frame(spark, [texts[i] for i in order]).coalesce(1).repartition(parts)
        found = substring_dedup.repeated_passages(docs)
        assert {(r.doc_id, r.first_doc_id, r.start, r.end, r.n_words) for r in found.collect()} == expected


def test_passages_inside_longer_texts(spark):
    """Found share by length of a common passage in fresh surroundings; spans stay inside the passage."""
    rng = np.random.default_rng(5)
    rows, inside = [], {}
    for length in (30, 35, 45):
        for _ in range(120):
            passage = [f"p{x}" for x in rng.integers(0, 10**6, length)]
            for _ in range(2):
                before, after = ([f"s{x}" for x in rng.integers(0, 10**6, rng.integers(30, 80))] for _ in range(2))
                rows.append((len(rows), " ".join(before + passage + after)))
            inside[len(rows) - 1] = (length, len(" ".join(before)) + 1, len(" ".join(before + passage)))
    found = {r.doc_id: r for r in substring_dedup.repeated_passages(frame(spark, rows)).collect()}
    assert set(found) <= set(inside)
    for d, r in found.items():
        assert r.first_doc_id == d - 1 and inside[d][1] <= r.start < r.end <= inside[d][2]
    for length, least in ((30, 0.7), (35, 0.93), (45, 1.0)):
        assert np.mean([d in found for d in inside if inside[d][0] == length]) >= least


def test_cuts_depend_on_the_text_alone():
    def cuts(texts):
        buf = np.frombuffer("".join(texts).encode(), np.uint8)
        off = np.cumsum([0, *(len(t.encode()) for t in texts)])
        starts, ends, rows = T.find_words(buf, off)
        mask = substring_dedup.chunk_cuts(buf, starts, ends, rows, substring_dedup.RADIUS)
        return [mask[rows == i].tolist() for i in range(len(texts))]
    texts = [words(900 + n, n) for n in (1, 2, 3, 5, 9, 30, 200)] + ["a a a a a b b b", "a " * 40]
    alone = [cuts([t])[0] for t in texts]
    for seed in range(5):
        order = np.random.default_rng(seed).permutation(len(texts))
        assert cuts([texts[i] for i in order]) == [alone[i] for i in order]


def test_targets_and_mix(spark):
    rows = [(i, words(i, 5 + i % 40), "en", s, 0) for i in range(300) for s in [["b", "a", None][i % 3] if i > 5 else "tiny"]]
    docs = spark.createDataFrame([*rows, (900, None, None, "a", None)], DOCS)
    out = mixing.taken_words(docs).toPandas()
    size = {}
    for _, t, _, s, _ in rows:
        size[s] = size.get(s, 0) + len(t.split())
    names = ["a", "b", "tiny", None]
    weight = dict(zip(names, (5, 2, 1, 5)))
    target, open_, rest = {}, set(names), float(sum(size.values()))
    while open_:  # plain rounds of sharing
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if rest * weight[s] / total > 3 * size[s]}
        if not over:
            target.update({s: rest * weight[s] / total for s in open_})
            break
        target.update({s: 3.0 * size[s] for s in over})
        rest -= sum(3.0 * size[s] for s in over)
        open_ -= over
    source = {r[0]: r[3] for r in rows} | {900: "a"}
    out["source"] = out.doc_id.map(source)
    for s in names:
        own = out[out.source.isna()] if s is None else out[out.source == s]
        assert own.source_size.iloc[0] == size[s] and own.target.iloc[0] == pytest.approx(target[s])
        assert abs(own.taken.sum() - target[s]) <= 45 and (own.taken <= 3 * own["size"]).all()
    again = mixing.taken_words(docs).toPandas().sort_values("doc_id").taken.tolist()
    assert again == out.sort_values("doc_id").taken.tolist()


def test_splitting_tree_deals_every_block_once():
    quotas = np.array([7, 0, 33, 120])
    parts = [mixing.split_tree_path(s, 5, quotas, 3) for s in range(5)]
    at = np.zeros(4, int)
    for offset, have in parts:
        assert (offset == at).all()
        at += have
    assert (at == quotas).all()


def test_toxicity_learns_and_scores_edges(spark):
    toxic = [(i, words(i, 30) + (" vile vile2" if i % 4 == 0 else ""), "en", "s", 0) for i in range(400)]
    docs = spark.createDataFrame([*toxic, (1000, None, None, None, None), (1001, "", None, None, 0)], DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(5, None)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(300, 400)) and got[1000] == got[1001] < 0.5
    nothing = toxicity.score(docs, toxicity.fit(docs, labels.where("false"))).agg({"score": "max"}).first()[0]
    assert nothing == 0


def test_ftrl_equals_a_plain_loop():
    rng = np.random.default_rng(4)
    xs = [np.unique(rng.integers(0, 64, 8)) for _ in range(60)]
    ys = [float(rng.random() < 0.3) for _ in xs]
    setting = toxicity.Setting(alpha=1.5, l1=0.5, positive=2)
    z, n = dict.fromkeys(range(65), 0.0), dict.fromkeys(range(65), 0.0)

    def weight(i):
        l1 = 0.0 if i == 64 else 0.5
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - (l1 if z[i] > 0 else -l1)) / ((1.0 + n[i] ** 0.5) / 1.5 + 0.01)

    for _ in range(4):
        for x, y in zip(xs, ys):
            at = [*map(int, x), 64]
            w = {i: weight(i) for i in at}
            g = (1 / (1 + np.exp(-sum(w.values()))) - y) * (2 if y else 1)
            for i in at:
                step = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 1.5
                n[i] += g * g
                z[i] += g - step * w[i]
    np.testing.assert_allclose(toxicity.ftrl(xs, ys, 6, setting), [weight(i) for i in range(65)], atol=1e-9)


def test_toxicity_catches_held_out_rows(spark):
    """Ten insults, one to three in a text of 40 to 160 words."""
    rng = np.random.default_rng(8)
    rows, truth = [], {}
    for i in range(3000):
        text = list(rng.choice(WORDS, rng.integers(40, 160)))
        truth[i] = i % 8 == 0
        for _ in range(rng.integers(1, 4) if truth[i] else 0):
            text.insert(rng.integers(0, len(text)), f"insult{rng.integers(0, 10)}")
        rows.append((i, " ".join(text)))
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(t)) for i, t in truth.items()], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, usable=F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.score(docs, model).where("doc_id % 5 = 0").collect()}
    assert np.mean([got[i] for i in got if truth[i]]) >= 0.95
    assert np.mean([got[i] for i in got if not truth[i]]) <= 0.01


def test_rule_counts(spark):
    line = "a b c d e f g h i"
    texts = [(1, f"{line}\n{line}\n## x|"), (2, None), (3, "\n \n"), (4, words(3, 50)), (5, "é " * 20)]
    got = {r.doc_id: r for r in weak_supervision.judge(frame(spark, texts)).collect()}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        seen = {}
        for j in range(len(w) - 7):
            seen.setdefault(tuple(w[j:j + 8]), []).append(j)
        covered = {k for v in seen.values() if len(v) > 1 for j in v for k in range(j, j + 8)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
    assert got[4].kept and not got[2].kept


def test_language_and_automaton(spark):
    codes = np.array([2, 3, 2, 2, 3, 4])
    a, state = language_id.suffix_automaton(codes), 0
    for c in (2, 3, 4):
        state = a[state, c]
        assert state >= 0
    docs = spark.createDataFrame([(i, ("der und das nicht " if i % 2 else "the and of that ") * (1 + i % 5), "de" if i % 2 else "en")
                                  for i in range(60)] + [(90, "12 !!", None), (91, None, None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.predict(docs, language_id.train(docs, queries.crc_remainder("doc_id", 3) != 1)).collect()}
    assert all(got[i].lang_pred == ("de" if i % 2 else "en") and 0 <= got[i].score <= 1 for i in range(60))
    assert got[90].lang_pred == got[91].lang_pred == "und"


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_a_rare_label_leaves_the_other_samples_whole(spark):
    rng = np.random.default_rng(5)
    letters = {"aa": "abcdefgh ", "bb": "ijklmnop "}
    rows = [(i, "".join(rng.choice(list(letters[x]), 600)), x) for i in range(80) for x in (["aa", "bb"][i % 2],)]
    rare = [(900, "tiny text", "cc")]
    plain, more = (language_id.samples(labelled(spark, r), F.lit(True)) for r in (rows, rows + rare))
    assert len(plain["aa"]) == len(plain["bb"]) == language_id.SAMPLE_CHARS
    assert sorted(more["cc"].split()) == ["text", "tiny"] and more == plain | {"cc": more["cc"]}
    model = language_id.train(labelled(spark, rows + rare), F.lit(True))
    assert model[4].tolist()[:2] == pytest.approx([np.log2(language_id.SAMPLE_CHARS)] * 2, rel=0.01)
    got = {r.doc_id: r.lang_pred for r in language_id.predict(labelled(spark, rows + rare), model).collect()}
    assert all(got[i] == x for i, _, x in rows)


def test_letters_of_large_scripts_are_told_apart(spark):
    rng = np.random.default_rng(8)
    alphabet = {"x": range(0x4E00, 0x5400), "y": range(0x5400, 0x5A00), "got": range(0x10330, 0x10340), "per": range(0x10350, 0x10360)}
    rows = [(i, "".join(map(chr, rng.choice(alphabet[x], 400))), x) for i in range(120) for x in (list(alphabet)[i % 4],)]
    rows += [(1000 + i, " ".join(rng.choice(["the", "quick", "fox", "jumps", "over", "zebra", "wolf"], 300)), "en") for i in range(40)]
    docs = labelled(spark, rows)
    model = language_id.train(docs, F.col("doc_id") % 8 < 4)
    got = {r.doc_id: r.lang_pred for r in language_id.predict(docs, model).collect()}
    assert [got[i] for i, _, _ in rows] == [x for _, _, x in rows]


def test_samples_are_filled_from_many_documents(spark):
    rng = np.random.default_rng(6)
    short = [(i, "".join(rng.choice(list("abcdefghij"), 30)), "short") for i in range(1000)]
    long = [(2000 + i, f"{chr(97 + i)}" * 20_000, "long") for i in range(26)] + [(2100 + i, "z" * (i + 1), "long") for i in range(5)]
    few = [(3000, "q" * 900, "few"), (3001, "r" * 50, "few"), (None, "s" * 70, "few"), (3002, "12", "few"), (3000, "q" * 900, "few")]
    rows = short + long + few
    first = language_id.samples(labelled(spark, rows).repartition(1), F.lit(True))
    assert len(first["short"]) == len(first["long"]) == language_id.SAMPLE_CHARS
    share = {ch: first["long"].count(ch) for ch in map(chr, range(97, 122))}
    assert min(share.values()) > 300 and max(share.values()) < 600  # no document has more than its share
    assert sorted(map(len, first["few"].split())) == [50, 70, 900]
    for parts in (3, 7):
        order = rng.permutation(len(rows))
        assert language_id.samples(labelled(spark, [rows[i] for i in order]).repartition(parts), F.lit(True)) == first


def test_leaks_match_brute_force(spark):
    items = [(0, words(50, 20)), (1, words(51, 70)), (2, "too short"), (3, None)]
    texts = [(1, words(52, 3000) + " " + items[0][1].upper() + " " + words(53, 500)), (2, items[1][1]), (3, words(54, 400)),
             (4, " ".join(items[1][1].split()[:50])), (5, None), (6, " ".join(items[1][1].split()[:64]) + " end")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()}
    def sh(t):
        w = (t or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    assert got == {(d, k) for d, t in texts for k, u in items if sh(u) and 100 * len(sh(t) & sh(u)) >= 80 * len(sh(u))} and (1, 0) in got


def test_items_that_share_an_id_are_matched_one_by_one(spark):
    a, b = words(61, 30), words(62, 30)
    items = spark.createDataFrame([(1, a), (1, b), (1, a.upper()), (2, a)], "item_id long, text string")
    docs = frame(spark, [(1, words(63, 200) + " " + a + " " + words(64, 100) + " " + b), (2, b), (3, words(65, 90))])
    rows = sorted((r.doc_id, r.item_id, r.n_item, r.n_found) for r in decontaminate.leaks(docs, items).collect())
    assert rows == [(1, 1, 26, 26), (1, 1, 26, 26), (1, 2, 26, 26), (2, 1, 26, 26)]


def test_short_items_are_found_in_long_documents(spark):
    items = [(100 * n + i, words(5000 + 100 * n + i, n)) for n in range(1, 13) for i in range(1 if n < 3 else 40)]
    text = lambda seed, own: " ".join(
        x for j, u in enumerate(own) for x in (words(seed + j, 3000 // max(1, len(own))), u.upper()))
    texts = [(i, text(7000 + 500 * i, [u for k, u in items if k % 8 == i])) for i in range(8)]
    texts += [(20, items[50][1]), (21, items[1][1]), (22, "unknown"), (23, ""), (24, None)]
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()}
    def sh(t, k):
        w = (t or "").lower().split()
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    expected = set()
    for k, u in items:
        n = min(5, len(u.split()))
        expected |= {(d, k) for d, t in texts if 100 * len(sh(t, n) & sh(u, n)) >= 80 * len(sh(u, n))}
    assert got == expected and {(k % 8, k) for k, _ in items} <= got


def test_license_notices(spark):
    mit = licenses.TEMPLATES["MIT"]
    texts = [(1, words(1, 30) + " Released under the MIT License. " + words(2, 30)), (2, mit.replace("merge, ", "").upper()),
             (3, "the " * 500), (4, None), (5, "Released under the BSD License.")]
    got = [(r.doc_id, r.license) for r in licenses.find_licenses(frame(spark, texts)).collect()]
    assert sorted(got) == [(1, "MIT-notice"), (2, "MIT")]
    assert licenses.patience_align(list("abcxd"), list("abyd")) == [(0, 0), (1, 1), (4, 3)]


def gnu(kind, version, thing="program"):
    return (f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the {kind} as published by "
            f"the Free Software Foundation; either version {version} of the License, or (at your option) any later version. This "
            f"{thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
            f"of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {kind} for more details.")


def test_identifiers_versions_and_negations(spark):
    texts = {1: ("Licensed under the Apache License 2.0", "Apache-2.0-notice"), 2: ("x\n// SPDX-License-Identifier: MIT\ny", "MIT-identifier"),
             3: ("This work is not licensed under a Creative Commons Attribution 4.0 International License.", None),
             4: ("It is not released under the MIT License.", None), 5: ("Licensed under the Apache License v2.0.", "Apache-2.0-notice"),
             6: ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later-identifier"),
             7: ("SPDX-License-Identifier: CC-BY-NC-SA-4.0", None), 8: ("Why not? Well. Released under the MIT License.", "MIT-notice"),
             9: ("Licensed under the GNU General Public License, version 2.", "GPL-2.0-notice"),
             10: ("SPDX-License-Identifier: CC-BY-SA-4.0", "CC-BY-SA-4.0-identifier")}
    got = {r.doc_id: r.license for r in licenses.find_licenses(frame(spark, [(i, t) for i, (t, _) in texts.items()])).collect()}
    assert got == {i: name for i, (_, name) in texts.items() if name}


def test_near_equal_licenses_are_told_apart(spark):
    bsd = licenses.TEMPLATES["BSD-3-Clause"]
    no_endorsement = re.sub(r"Neither the name.*?permission\.", "", bsd)
    texts = [gnu("GNU General Public License", "2"), gnu("GNU General Public License", "3"), gnu("GNU Lesser General Public License", "2.1", "library"),
             gnu("GNU Lesser General Public License", "3"), gnu("GNU Affero General Public License", "3"), gnu("GNU Library General Public License", "2"),
             bsd.replace("COPYRIGHT HOLDER OR", "REGENTS OR"), no_endorsement, "Released under MIT License.",
             "Distributed under the GNU General Public License, version 2.", "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY 4.0"]
    names = ["GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "LGPL-2.0", "BSD-3-Clause", "BSD-2-Clause", "MIT-notice", "GPL-2.0-notice",
             "CC-BY-NC-SA-4.0-notice", "CC-BY-4.0-notice"]
    full = {k: v for k, v in licenses.all_templates().items() if k.endswith("-text")}
    texts, names = texts + list(full.values()), names + list(full)
    rows = [(i, f"{words(i, 30)} {t} {words(i + 50, 30)}") for i, t in enumerate(texts)]
    got = sorted((r.doc_id, r.license) for r in licenses.find_licenses(frame(spark, rows)).collect())
    assert got == list(enumerate(names))


def test_packages_round_trip(spark):
    pages = [(1, "http://a/é", "<p>x</p>"), (2, None, None), (3, "http://b", "<p>x</p>"), (4, "http://c", ""), (None, "http://d", "q"), (5, "u", "<é>")]
    got = {r.page_id: r for r in zip_warc.round_trip(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert len(got) == 6
    for k, _, html in pages:
        raw = (html or "").encode()
        assert (got[k].payload_bytes, got[k].payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
    assert {k: r.refers_to for k, r in got.items() if r.record_type == "revisit"} == {3: 1, 4: 2}


def test_zip64_directory_and_damage():
    w = zip_warc.PackageWriter()
    w.add(1, "u", b"abc", None, zip_warc.payload_digest(b"abc"))
    raw = w.package(zip64=True)
    members = zip_warc.central_directory(io.BytesIO(raw), len(raw))
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        for m in members:
            assert raw[m["data"]:m["data"] + m["size"]] == z.read(m["name"])
    assert list(zip_warc.gzip_members(io.BytesIO(raw), members[0]["data"], members[0]["size"])) == [(0, members[0]["size"])]
    with pytest.raises(ValueError):
        zip_warc.central_directory(io.BytesIO(raw[:-30]), len(raw) - 30)


def test_separator_scan_stitches_blocks(spark, tmp_path):
    ids = [3, 9, 9, 1, 2, 3, 4, 9, 5]  # 9 ends a document; the last one is open
    p = tmp_path / "t.bin"
    np.array(ids, "<u2").tofile(p)
    files = spark.createDataFrame([(f"file://{p}",)], "file string")
    for block in (1, 2, 4, 100):
        d = token_counts.documents(token_counts.scan_blocks(token_counts.list_blocks(spark, files, block), 9))
        assert [(r.ordinal, r.start, r.n_tokens, r.terminated) for r in d.orderBy("ordinal").collect()] == [
            (0, 0, 1, True), (1, 2, 0, True), (2, 3, 4, True), (3, 8, 1, False)]


@pytest.mark.skipif(not os.path.exists(queries.TOKENIZER_PATH), reason="vocabulary files are not here")
def test_token_counts_round_trip(spark):
    ranks = token_counts.load_ranks(queries.TOKENIZER_PATH)
    enc = token_counts._encoding(ranks, queries.SPLIT_PATTERN)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, "")], "doc_id long, text string"))
    got = {r.doc_id: r.n_tokens for r in token_counts.count_documents(docs, ranks, queries.SPLIT_PATTERN, block_tokens=1000).collect()}
    assert got == {r.doc_id: len(enc.encode_ordinary(r.text or "")) for r in docs.collect()}

@pytest.fixture
def many_partitions(spark):
    """Shuffles into 64 partitions that Spark does not merge."""
    own = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_few_links_take_few_tasks(many_partitions):
    from revlens.llm._stage import ROWS_A_TASK, connected_components, narrow
    spark = many_partitions
    # 40 chains of 9 ids, repeated links, a self link and null ends
    links = [(c * 100 + i, c * 100 + i + 1) for c in range(40) for i in range(8)]
    rows = [*links, *((b, a) for a, b in links[::3]), (7, 7), (None, 5), (6, None)]
    comp = connected_components(spark.createDataFrame(rows, "a long, b long"))
    assert sorted(map(tuple, comp.collect())) == sorted((c * 100 + i, c * 100) for c in range(40) for i in range(9))
    cores = spark.sparkContext.defaultParallelism
    assert len(set(comp.inputFiles())) <= cores < 64  # a written file a task
    wide = spark.range(ROWS_A_TASK * 100).repartition(64)
    assert narrow(wide, ROWS_A_TASK * 100).rdd.getNumPartitions() == 64  # many rows keep their tasks


def test_near_copies_in_many_partitions(many_partitions):
    """Classes of linked texts over several rounds, against all pairs."""
    spark = many_partitions
    base = {g: [f"g{g}w{i}" for i in range(60)] for g in range(4)}
    texts = []
    for g, words in base.items():
        for j in range(12):
            w = list(words)
            w[j] = f"x{g}_{j % 5}"  # neighbours share most shingles, some copies are exact
            texts.append(" ".join(w))
    texts += ["one two", "one two", "", None, "alone in the whole corpus of texts"]
    docs = [(1000 - 7 * i, t) for i, t in enumerate(texts)]

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set()

    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == sorted((i, len(s), root(i)) for i, s in sets.items())


def test_components_send_no_join_side_to_the_driver(spark, monkeypatch):
    from revlens.llm import _stage
    plans, plain = [], _stage.stage
    monkeypatch.setattr(_stage, "stage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df, name))
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (6, None)], "a long, b long")
    got = {r.id: r.component for r in _stage.connected_components(links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7}
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)
