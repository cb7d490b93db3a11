"""The audit of sources against plain Python, with runs, pieces and blocks made very small."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from conform.llm import divergence
from conform.llm.divergence import Postings, _pieces, merged, source_divergence, terms

SCHEMA = "doc_id long, text string, lang string, source string, term string, p long, size int"
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents():
    draw = random.Random(5)
    words = ["Haus", "haus", "Äpfel", "äpfel", "a", "b", "c", "\U0001f600", "z\u0000y", "x-1"]
    rows = []
    for i in range(300):
        lang = draw.choice(["de", "en", None, ""])
        source = draw.choice(["s1", "s2", "s3", "", None, "é"])
        count = draw.choice([0, 1, 5, 40])
        text = " ".join(draw.choice(words) + draw.choice(["", "q", "Q"]) for _ in range(count))
        rows.append((i, text, lang, source, "t", 1, 1))
    rows += [
        (None, None, "de", "s1", "t", 1, 1),
        (400, "", "de", "without words", "t", 1, 1),
        (401, "nur hier", "fr", "few", "t", 1, 1),  # a language without kept terms
        (402, "", "fr", "none", "t", 1, 1),
        (403, "Wort " * 50_000, "de", "s1", "t", 1, 1),
        (404, "Wort", "de", "s1", "t", 1, 1),
        (405, "Wort", "de", "s2", "t", 1, 1),
    ]
    return rows + rows[:5]


def expected(rows):
    whole = 10**9
    counts, within, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        words = WORD.findall((text or "").translate(UPPER))
        groups.add((lang, source))
        counts[lang, source].update(words)
        total[lang].update(words)
        within[lang].update(set(words))
    found = []
    for lang in {lang for lang, _ in groups}:
        kept = [w for w, n in within[lang].items() if n >= 3]

        def chances(counter):
            mass = sum(counter[w] for w in kept)
            return {w: 1 + whole * (counter[w] + 1) // (mass + len(kept)) for w in kept}

        q = chances(total[lang])
        p = {s: chances(counts[lang, s]) for other, s in groups if other == lang}
        for source, own in p.items():
            pairs = [
                (sum((own[w] - other[w]) ** 2 // other[w] for w in kept), item)
                for item, other in p.items()
                if item != source
            ]
            leaning = [
                ((own[w] - q[w]) ** 2 // q[w], w)
                for w in kept
                if counts[lang, source][w] and own[w] > q[w]
            ]
            for part, values, limit in (("pair", pairs, None), ("term", leaning, 200)):
                values.sort(key=lambda v: (-v[0], v[1].encode()))
                found += [
                    (lang, source, part, item, value, rank)
                    for rank, (value, item) in enumerate(values[:limit], 1)
                ]
    return sorted(found)


def told(spark, rows, shards=None):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted(map(tuple, source_divergence(frame, shards).collect()))


def test_divergence_matches_plain_python(spark):
    rows = documents()
    assert told(spark, rows) == expected(rows)


@pytest.mark.parametrize("piece, window", [(2, 1), (1, 3), (3, 7)])
def test_runs_are_merged_whole(monkeypatch, piece, window):
    """Many runs of many pieces, a few of them taken up at once."""
    rows = documents()[:60] + documents()[-9:]
    monkeypatch.setattr(divergence, "PIECE", piece)
    monkeypatch.setattr(divergence, "WINDOW", window)
    postings, batches = Postings(), []
    counts, within = Counter(), Counter()
    for _, text, lang, source, *_ in rows:
        postings.add(lang or "", source or "", text or "")
        words = terms(text or "")
        counts.update((lang or "", source or "", t) for t in words)
        within.update((lang or "", t) for t in set(words))
        if postings.held >= 20:
            batches += postings.run(3)
    batches += postings.run(3)
    pieces = pa.Table.from_batches(batches)
    assert pieces.num_rows > 20 and postings.held == 0
    assert max(map(len, pieces["terms"].to_pylist())) <= piece
    again, documents_of = Counter(), Counter()
    keys = [pieces[name].to_pylist() for name in ("shard", "lang", "first")]
    sources: dict = {}
    for shard, lang in sorted(set(zip(*keys[:2]))):
        own = [n for n, key in enumerate(zip(*keys)) if key[:2] == (shard, lang)]
        own.sort(key=lambda n: keys[2][n])
        ordered = pieces.take(own).combine_chunks().to_batches()
        seen = []
        for words, of, term, owner, n in merged(p[1:] for p in _pieces(ordered, sources)):
            names, words = list(sources), words.to_pylist()
            seen += words
            documents_of.update({(lang, w): int(x) for w, x in zip(words, of)})
            for t, o, x in zip(term, owner, n):
                again[lang, names[o], words[t]] += int(x)
        assert seen == sorted(set(seen))
    assert again == counts and documents_of == within


@pytest.mark.parametrize("pairs", [1, 7, 1000])
def test_corrections_a_few_pairs_at_once(monkeypatch, pairs):
    monkeypatch.setattr(divergence, "PAIRS", pairs)
    block = [("l", "t1", s, p, 3) for s, p in (("a", 50), ("b", 7), ("c", 9))]
    block += [("l", "t2", s, p, 4) for s, p in (("b", 30), ("c", 8))] + [("m", "t3", "a", 2, 1)]
    summed = Counter()
    columns = dict(zip(("lang", "term", "source", "p", "p0"), zip(*block)))
    for found in divergence._block(pa.table({k: list(v) for k, v in columns.items()})):
        summed.update(found)
    plain = Counter()
    for one in block:
        for two in block:
            if one[:2] == two[:2] and one[2] != two[2]:
                f = [[(a - b) ** 2 // b for b in two[3:]] for a in one[3:]]
                plain[one[0], one[2], two[2]] += f[0][0] - f[0][1] - f[1][0] + f[1][1]
    assert summed == plain


def test_any_number_of_shards(spark):
    rows = documents()
    assert told(spark, rows, 1) == told(spark, rows, 50) == expected(rows)


def test_terms():
    assert terms("Don't ÄBÄ x\u0000y _a1") == [b"don", b"t", "ÄbÄ".encode(), b"x", b"y", b"a"]
