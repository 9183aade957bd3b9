"""Language ID by cross-parsing entropy with suffix automata.

For each language a suffix automaton of a bounded sample of labelled text is
built.  A text is parsed against it greedily: from the current place the
longest string that occurs in the sample is one phrase, then the next phrase
begins.  The entropy estimate is phrases * log2(sample length) per character,
by each language's own sample length; a letter that the sample lacks costs as
much as the dearest phrase of any language, so a short sample gains nothing by
it.  The language with the smallest estimate wins.

The alphabet has every letter of the samples; runs of characters that are no
letters are one blank, and a letter that no sample has is an unknown mark.  The
automaton is a dense transition table over the ``ALPHABET`` most frequent codes
and a sorted list of the transitions by all others, and a walk from the root
finds the longest match without suffix links.  All texts of
a block are walked in step, in pieces of ``PIECE`` characters; pieces cover the
whole text, and a phrase ends with its piece in every language alike.

Bounds: ``SAMPLE_CHARS`` characters per language, taken from documents in the
order of a hash of their text.  A document gives ``SHARE_CHARS`` characters
(from a hashed place on, going round at its end) as long as that fills the
sample; where all texts together do not, the share rises until the sample is
full or every text is in it.  Equal texts count once.  One table has at most
``2 * SAMPLE_CHARS * ALPHABET`` cells of four bytes, one list at most
``3 * SAMPLE_CHARS`` transitions.

Defined results: a null text or one without a letter is ``und`` with score 0;
ties go to the smaller language name; without any labelled text all is
``und``; rows with a null id are learnt from too; repeated rows are predicted row by row; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_CHARS = 12_000
SHARE_CHARS = 300
MERGE_TASKS = 16
PIECE = 512
ALPHABET = 64
BLOCK_CHARS = 1 << 20
BLANK, UNKNOWN = 0, 1

_is_letter = np.array([chr(c).isalpha() for c in range(0x110000)])


def automaton_states(codes: np.ndarray) -> list[dict[int, int]]:
    """Transitions of each state of the automaton of all substrings (state 0 is the root)."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes.tolist():
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


def tables(states: list[dict[int, int]], base: int, n_codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dense transitions by the frequent codes (-1 where none), and keys and targets of those by all others."""
    s, c, to = (np.array(x, np.int64) for x in zip(*((i, c, t) for i, row in enumerate(states) for c, t in row.items()))) \
        if any(states) else (np.zeros(0, np.int64),) * 3
    dense, often = np.full((len(states), ALPHABET), -1, np.int32), c < ALPHABET
    dense[s[often], c[often]] = to[often] + base
    keys = (s[~often] + base) * n_codes + c[~often]
    order = np.argsort(keys)
    return dense, keys[order], (to[~often] + base)[order].astype(np.int32)


def suffix_automaton(codes: np.ndarray) -> np.ndarray:
    """Dense transitions of the automaton of ``codes``; -1 where none (state 0 is the root)."""
    return tables(automaton_states(codes), 0, int(codes.max(initial=0)) + 1)[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def fold(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Alphabet codes; runs of characters that are no letters become one blank."""
    codes = table[points]
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != BLANK) | (codes[:-1] != BLANK)
    return codes[keep]


def level(lengths, budget: int, share: int) -> int:
    """Characters that each document gives: ``share``, or more where that does not fill ``budget``."""
    left, n = budget, len(lengths)
    for x in sorted(lengths):
        if x * n >= left:
            return max(share, -(-left // n))
        left, n = left - x, n - 1
    return max([share, *lengths])


def choose(found: dict, budget: int, share: int) -> dict:
    """Of ``(hash, letters) -> characters`` the first by hash that fill the sample, cut to their share."""
    order, total = sorted(found), 0
    for n, x in enumerate(order):
        total += min(len(found[x]) + 1, share)
        if total >= budget:
            order = order[:n + 1]
            break
    cut = level([len(found[x]) + 1 for x in order], budget, share)
    return {x: found[x][:cut] for x in order}


def _letters(text: str) -> str:
    """Lower-case letters, every run of other characters one blank."""
    return " ".join("".join(ch if ch.isalpha() else " " for ch in text.lower()).split())


def _pick(budget: int, share: int):
    """Per language those rows ``lang, h, text`` of the task that its sample may need.

    A choice from part of the documents keeps, of each, no less than a choice
    from all of them would, so choices may be merged in any order.
    """
    def run(batches):
        found: dict[str, dict] = {}
        last: dict[str, int] = {}
        total: dict[str, int] = {}
        for batch in batches:
            for lang, h, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "h", "text"))):
                own = found.setdefault(lang, {})
                if h > last.get(lang, h):
                    continue
                if "piece" not in batch.schema.names:
                    text = _letters(text)
                    # from a hashed word on, going round
                    at = text.find(" ", (h & 0xFFFFFFFF) % max(1, len(text))) + 1
                    text = (text[at:] + " " + text[:at]).strip()[:budget]
                if not text:
                    continue
                total[lang] = total.get(lang, 0) + (0 if h in own else min(len(text) + 1, share))
                own[h] = max(own.get(h, ""), text, key=lambda x: (len(x), x))
                if total[lang] >= 2 * budget:
                    found[lang] = own = choose(own, budget, share)
                    last[lang] = max(own)
                    total[lang] = sum(min(len(x) + 1, share) for x in own.values())
        rows = [(lang, h, text, True) for lang, own in sorted(found.items()) for h, text in choose(own, budget, share).items()]
        cols = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.string(), pa.int64(), pa.string(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["lang", "h", "text", "piece"])
    return run


def samples(docs: DataFrame, usable, sample_chars: int = SAMPLE_CHARS, share_chars: int = SHARE_CHARS) -> dict[str, str]:
    """Sample text of each language; the same for every order and partitioning of ``docs``."""
    lab = docs.where(usable).where("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.xxhash64("text").alias("h"), "text")
    kind = "lang string, h long, text string, piece boolean"
    picked = lab.mapInArrow(_pick(sample_chars, share_chars), kind)
    rows = picked.repartition(MERGE_TASKS).mapInArrow(_pick(sample_chars, share_chars), kind).collect()
    found: dict[str, dict] = {}
    for r in rows:
        own = found.setdefault(r.lang, {})
        own[r.h] = max(own.get(r.h, ""), r.text, key=lambda x: (len(x), x))
    chosen = {x: choose(own, sample_chars, share_chars) for x, own in found.items() if own}
    return {x: " ".join(own[h] for h in sorted(own))[:sample_chars] for x, own in chosen.items()}


def train(docs: DataFrame, usable, sample_chars: int = SAMPLE_CHARS, share_chars: int = SHARE_CHARS):
    """``(languages, folding table, transitions, root of each language, bits of a phrase)`` from labelled documents."""
    texts = samples(docs, usable, sample_chars, share_chars)
    langs = sorted(texts)
    points = {x: code_points(texts[x]) for x in langs}
    table = np.full(len(_is_letter), UNKNOWN, np.int32)
    table[~_is_letter] = BLANK
    n_codes = 2
    if langs:
        used, n = np.unique(np.concatenate(list(points.values())), return_counts=True)
        letters = used[_is_letter[used]]
        letters = letters[np.argsort(-n[_is_letter[used]], kind="stable")]
        n_codes += len(letters)
        table[letters] = np.arange(2, n_codes)
    folded = [fold(points[x], table) for x in langs]
    bits = [float(np.log2(max(2, len(f)))) for f in folded]
    roots, parts, base = [], [tables([], 0, n_codes)], 0
    for f in folded:
        roots.append(base)
        parts.append(tables(automaton_states(f), base, n_codes))
        base += len(parts[-1][0])
    nxt = tuple(np.concatenate(x) for x in zip(*parts))  # keys rise with the state, so they stay sorted
    return langs, table, (*nxt, n_codes), np.array(roots, np.int32), np.array(bits)


def follow(nxt, state: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Next state of each row and column of ``state`` by the code of its column; -1 where none."""
    dense, keys, targets, n_codes = nxt
    to = dense.ravel()[state * ALPHABET + np.minimum(c, ALPHABET - 1)]
    seldom = np.flatnonzero(c >= ALPHABET)
    if len(seldom):
        key = state[:, seldom].astype(np.int64) * n_codes + c[seldom]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        to[:, seldom] = np.where(keys[at] == key, targets[at], -1)
    return to


def count_phrases(pieces: np.ndarray, lengths: np.ndarray, nxt, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases, and letters that no phrase can hold, of each piece against each language; pieces sorted by length, longest first."""
    n, k = len(lengths), len(roots)
    root = np.repeat(roots[:, None], n, 1)
    state = root.copy()
    phrases, lacking = np.zeros((k, n), np.int32), np.zeros((k, n), np.int32)
    for t in range(int(lengths[0]) if n else 0):
        m = int(np.searchsorted(-lengths, -t, "left"))  # pieces longer than t
        c = pieces[t, :m]
        to = follow(nxt, state[:, :m], c)
        ended = to < 0
        fresh = state[:, :m] == root[:, :m]
        phrases[:, :m] += fresh & ~ended  # a phrase begins
        if ended.any():
            again = follow(nxt, root[:, :m], c)
            phrases[:, :m] += ended & (again >= 0)
            lacking[:, :m] += ended & (again < 0)
            to = np.where(ended, np.where(again < 0, root[:, :m], again), to)
        state[:, :m] = to
    return phrases, lacking


def predict_block(texts: list[str | None], model) -> tuple[list[str], np.ndarray]:
    langs, table, nxt, roots, bits = model
    names, scores = ["und"] * len(texts), np.zeros(len(texts))
    codes, owner = [], []
    for i, t in enumerate(texts):
        if t and langs:
            p = code_points(t)
            if _is_letter[p].any():
                f = fold(p, table)
                for a in range(0, len(f), PIECE):
                    codes.append(f[a:a + PIECE])
                    owner.append(i)
    if not codes:
        return names, scores
    lengths = np.array([len(c) for c in codes])
    order = np.argsort(-lengths, kind="stable")
    grid = np.zeros((PIECE, len(codes)), np.int32)
    for j, o in enumerate(order):
        grid[:lengths[o], j] = codes[o]
    phrases, lacking = count_phrases(grid, lengths[order], nxt, roots)
    who = np.array(owner)[order]
    cost = np.array([np.bincount(who, b * p + bits.max() * q, minlength=len(texts)) for b, p, q in zip(bits, phrases, lacking)])
    total = np.bincount(np.array(owner), lengths, minlength=len(texts))
    for i in np.flatnonzero(total):
        best = int(np.argmin(cost[:, i]))
        names[i] = langs[best]
        # share of the winner when every saved bit counts: softmax of the entropies, base two, over the text
        gap = np.clip(cost[:, i] - cost[best, i], 0, 60)
        scores[i] = 1.0 / np.exp2(-gap).sum()
    return names, scores


def predict(docs: DataFrame, model) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for batch in batches:
            texts, lo = batch.column("text").to_pylist(), 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size < BLOCK_CHARS):
                    size += len(texts[hi] or "")
                    hi += 1
                names, scores = predict_block(texts[lo:hi], m)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(names, pa.string()),
                                                  pa.array(scores)], ["doc_id", "lang_pred", "score"])
                lo = hi

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double")
