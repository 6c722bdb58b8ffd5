"""Parts of the operators without Spark, and their invariants."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from folioforge.llm.exact_dedup import SLOT_BITS, directory
from folioforge.llm.jaccard_join import merged, search
from folioforge.llm.language_id import Classifier, grams, ranked
from folioforge.llm.packing import Schedule
from folioforge.llm.quality import measure_text


def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_encoder_gives_the_librarys_ids():
    from tokenizers import Tokenizer

    from folioforge.llm.tokens import PieceEncoder

    whole = Tokenizer.from_file(vocabulary())
    rng = random.Random(3)
    letters = ["a", "é", "Z", " ", " ", "\n", "\t", "  ", ".", "'", "'s", "9", "½", "日", " the", "<|endoftext|>", " ", "…", "!!", "\x00"]
    texts = ["", " ", "a", None, *("".join(rng.choices(letters, k=rng.randrange(1, 40))) for _ in range(400))]
    expected = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    for enc in (PieceEncoder(vocabulary()), PieceEncoder(vocabulary(), max_chunks=50, slice_bytes=300)):
        for _ in range(2):  # the second time from the cache
            got = list(enc.encode(pa.array(texts), 2))
            assert np.concatenate([i for i, _ in got]).tolist() == [i for ids in expected for i in [*ids, 2]]
            assert np.concatenate([n for _, n in got]).tolist() == [len(ids) + 1 for ids in expected]


def test_other_vocabularies_are_encoded_whole():
    from tokenizers import Tokenizer

    from folioforge.llm.tokens import PieceEncoder

    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    texts = ["Hello World", "a  b", "", "x <|endoftext|> y", "12 don't"]
    enc, whole = PieceEncoder(path), Tokenizer.from_file(path)
    ids, counts = next(enc.encode(pa.array(texts)))
    expected = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert not enc.bytewise and ids.tolist() == [i for x in expected for i in x] and counts.tolist() == [len(x) for x in expected]


def test_directory_splits_until_buckets_fit():
    rng = random.Random(1)
    hashes = [rng.randrange(1 << 64) for _ in range(900)] + [(5 << 61) + rng.randrange(1 << 50) for _ in range(300)] + [7] * 40
    asked = []

    def count(depth, start, prefixes):
        asked.append((depth, start))
        return Counter(h >> (64 - depth) for h in hashes if (h >> (64 - start) if start else 0) in prefixes)

    buckets = directory(count, 20, 3)
    assert len(asked) > 2 and asked[0] == (3, 0)
    held = Counter()
    for h in hashes:
        found = [(d, p) for d, p in buckets if h >> (64 - d) == p] if buckets != [(0, 0)] else buckets
        assert len(found) == 1
        held[found[0]] += 1
    assert all(n <= 20 for (d, p), n in held.items() if d < SLOT_BITS)
    # A bucket and its neighbour would not have fitted into one.
    assert all(sum(n for (d2, p2), n in held.items() if d2 >= d and p2 >> (d2 - d + 1) == p >> 1) > 20 for d, p in buckets if d)
    assert directory(lambda *_: {}, 1, 1) == [(0, 0)]


def brute_links(sets, percent):
    return {(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])}


def roots(n, links):
    p = list(range(n))
    for a, b in links:
        a, b = _find(p, a), _find(p, b)
        p[max(a, b)] = min(a, b)
    return [_find(p, i) for i in range(n)]


def _find(p, x):
    while p[x] != x:
        x = p[x]
    return x


@pytest.mark.parametrize("seed", range(6))
def test_search_joins_what_all_pairs_join(seed):
    rng = random.Random(seed)
    sets = []
    for _ in range(60):
        base = set(rng.sample(range(4000), rng.choice([1, 3, 7, 40, 90])))
        for _ in range(rng.choice([1, 1, 2, 6])):  # near copies, some just at the bound
            s = set(base)
            for _ in range(rng.randrange(0, 1 + len(s) // 5)):
                s.discard(next(iter(s)))
                s.add(rng.randrange(4000))
            sets.append(s)
    arrays = [np.array(sorted(s), np.int64) for s in sets]
    ids = np.arange(len(sets))
    for percent in (80, 85):
        links = brute_links(sets, percent)
        found = search(ids, arrays, percent)
        assert roots(len(sets), found) == roots(len(sets), links) and {tuple(sorted(x, reverse=True)) for x in found} <= links
        # Two sides: what links across them join, given what is joined already.
        side = np.array([rng.randrange(2) for _ in sets])
        label = np.array(roots(len(sets), [x for x in links if side[x[0]] == side[x[1]]]))
        found = search(ids, arrays, percent, label, side)
        assert all(side[a] != side[b] for a, b in found) and {tuple(sorted(x, reverse=True)) for x in found} <= links
        known = [(i, int(r)) for i, r in enumerate(label)]
        assert roots(len(sets), found + known) == roots(len(sets), links)


def test_merged_counts():
    lists = [np.array(sorted(random.Random(i).sample(range(50), 20))) for i in range(9)]
    expected = {k: n for k, n in Counter(v for x in lists for v in x.tolist()).items() if n >= 4}
    assert dict(merged(lists, 4)) == expected and dict(merged([], 1)) == {}
    assert dict(merged([np.arange(5000), np.arange(0, 5000, 2)], 2)) == dict.fromkeys(range(0, 5000, 2), 2)


@pytest.mark.parametrize("weights", [None, [3, 1, 0, 2]])
def test_schedule_is_a_gapless_stream_with_exact_shares(weights):
    tokens = [10_000, 3_333, 1, 777]
    s = Schedule(tokens, weights or tokens, 500)
    at = {}
    for q, n in enumerate(tokens):
        start = 0
        while start < n:
            size = min(n - start, 97)
            for place, k in s.runs(q, start, size):
                for i in range(k):
                    assert place + i not in at
                    at[place + i] = q
            start += size
    assert sorted(at) == list(range(sum(tokens)))
    if weights is None:
        for w in range(s.windows - 1):
            places, before = s.window(w)
            sent = [s.sent(q, w + 1) - b for q, b in enumerate(before)]
            assert all(abs(x - 500 * t / sum(tokens)) < 1 for x, t in zip(sent, tokens)), w  # deficits stay below a token
            assert abs(s.sent(0, w + 1) - 500 * (w + 1) * tokens[0] / sum(tokens)) < 1


def test_quality_measures_by_the_letter():
    rng = random.Random(2)
    pieces = ["a", "b", "ab#", "é", "\n", "\n", " ", "\t", "x y z", "<&>", " ", "\x1c"]
    texts = ["", " ", "\n\n", *("".join(p + rng.choice(" \n ") for p in rng.choices(pieces, k=rng.randrange(1, 120))) for _ in range(300))]
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        assert measure_text(t) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered))


def test_rank_order():
    codes, counts = grams("Ab ab, 12 ab")
    by = dict(zip(codes.tolist(), counts.tolist()))
    assert by[ord("a")] == 3 and by[ord("a") << 21 | ord("b")] == 3 and ord("1") not in by
    assert ranked(codes, counts, 3).tolist() == sorted(k for k, n in by.items() if n == 3)[:3]
    model = Classifier({"x": grams("aaa bbb aab")[0].tolist(), "y": grams("ccc ddd")[0].tolist()}, 50)
    assert model.predict("aab")[0] == "x" and model.predict("cd")[0] == "y"
    assert [model.predict(t) for t in (None, "", "12 ½ --")] == [("und", 0.0)] * 3 and Classifier({}, 5).predict("a") == ("und", 0.0)
