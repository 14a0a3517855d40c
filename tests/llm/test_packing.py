import random
import zlib
from collections import Counter

import numpy as np
import pytest

from helpers import AWKWARD, frame, prose
from tidemark.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def filled(counts, capacity):
    """Contents of each sequence of a plan, checked for gaps, overlaps and lost pieces."""
    sequences, taken = {}, {s: set() for s in counts}
    entries = packing.plan(counts, capacity)
    for size, n in counts.items():
        own = [e for e in entries if e[0] == size]
        firsts = [e[1] for e in own]
        assert firsts == sorted(firsts)
        for rank in range(n):
            _, first, sequence, each, offset = [e for e in own if e[1] <= rank][-1]
            place = sequence + (rank - first) // each, offset + (rank - first) % each * size
            assert place not in taken[size]
            taken[size].add(place)
            sequences.setdefault(place[0], []).append((place[1], size))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= capacity
    return [sorted(s for _, s in parts) for parts in sequences.values()]


def plain(counts, capacity):
    """The same rule piece by piece: number of pairs of large pieces, and of sequences."""
    items = sorted((s for s, n in counts.items() for _ in range(n)), reverse=True)
    large, gaps, pairs = [s for s in items if 3 * s > capacity], [], 0
    while large:
        size = large.pop(0)
        mate = next((t for t in large if t + size <= capacity), None)
        if mate is not None:
            large.remove(mate)
            pairs += 1
        gaps.append(capacity - size - (mate or 0))
    for size in (s for s in items if 3 * s <= capacity):
        room = [g for g in gaps if g >= size]
        if room:
            gaps.remove(min(room))
            gaps.append(min(room) - size)
        else:
            gaps.append(capacity - size)
    return pairs, len(gaps)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_that_of_single_pieces(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 12, 30, 64])
    counts = dict(Counter(rng.randint(1, rng.choice([capacity, capacity // 2, capacity // 3])) for _ in range(rng.randint(0, 150))))
    got = filled(counts, capacity)
    pairs = sum(sum(3 * s > capacity for s in parts) == 2 for parts in got)
    assert (pairs, len(got)) == plain(counts, capacity)


def test_pairs_are_as_many_as_possible():
    import itertools

    def most(sizes, capacity):
        if len(sizes) < 2:
            return 0
        first, *rest = sizes
        return max([most(rest, capacity)] + [1 + most(rest[:i] + rest[i + 1:], capacity) for i, t in enumerate(rest) if first + t <= capacity])

    for sizes in itertools.combinations_with_replacement((4, 5, 6, 7, 8), 6):
        assert plain(Counter(sizes), 11)[0] == most(list(sizes), 11)


def test_plan_stays_small():
    rng = random.Random(1)
    counts = {s: rng.randint(1, 10**9) for s in range(1, 2049)}
    entries = packing.plan(counts, 2048)
    assert len(entries) < 8 * 2048
    assert max(e[2] for e in entries) < 1.01 * sum(s * n for s, n in counts.items() if s <= 2048) / 2048 + sum(n for s, n in counts.items() if s > 1024)


ODD = ["'s don't 12 <|endoftext|>  x\r\ny z", "  two  blanks \n\n lines", "tab\t\tx \x0b y", "ﬁ ǅ ½ ² ٣ 中文 é", "ÀÉ øß × ÷ ª º", "it's IT'S we'll"]


def test_both_ways_give_the_tokenizers_ids():
    from tokenizers import Tokenizer

    tokenizer, encode = Tokenizer.from_file(TOKENIZER), packing.Encoder(TOKENIZER, RANKS)
    rng = random.Random(4)
    alphabet = [*" \n\t\r\x0b'.,!-_<|>09aBZzéÉßøÿ×½ ́", "  ", "'s", "'LL", "<|endoftext|>", "中", "word", " the"]
    for text in ODD + ["".join(rng.choices(alphabet, k=rng.randrange(20))) for _ in range(4000)]:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_pieces_and_places(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = AWKWARD + [(i, prose(i, 7 * i)) for i in range(1, 40)] + [(50, "long " * 3000)] + [(60 + i, t) for i, t in enumerate(ODD)] + [(70, "same"), (70, "same"), (None, None)]
    got = packing.packed(frame(spark, rows).repartition(5), TOKENIZER, RANKS, 200, 0, keep_ids=True).collect()
    documents = Counter()
    by_id = {}
    for r in got:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 and 0 < r.length <= 200
        by_id.setdefault(r.doc_id, []).append(r)
    for doc_id, text, *_ in rows:
        documents[doc_id, np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()] += 1
    for (doc_id, ids), n in documents.items():
        first = (len(ids) // 4 - 1) % 200 + 1
        edges = [0, *range(first, len(ids) // 4 + 1, 200)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            assert sum((r.piece, r.start, r.ids) == (k, a, ids[4 * a:4 * b]) for r in by_id[doc_id]) >= n
    assert len(got) == sum(n * -(-len(ids) // 800) for (_, ids), n in documents.items())
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 200
    assert len(sequences) == plain(Counter(r.length for r in got), 200)[1]


def test_empty_table(spark):
    assert packing.packed(frame(spark, AWKWARD).limit(0), TOKENIZER, RANKS).count() == 0
