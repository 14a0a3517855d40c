import numpy as np
from helpers import AWKWARD, frame, prose
from tidemark.llm import decontaminate as dec

ITEMS = [
    (1, "Tom Baker has 12 apples and gives 5 apples to Mary. Then Tom Baker walks 3 km to the old market hall."),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today"),
    (3, "five short words only here"),
    (4, "too short"),
    (5, None),
    (6, ""),
]


def found(spark, rows, items=ITEMS):
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    return {(r.doc_id, r.item_id): r for r in dec.contaminated(frame(spark, rows), benchmark).collect()}


def test_verbatim_passages_and_clean_documents(spark):
    rows = AWKWARD + [
        (1, prose(1, 30) + " " + ITEMS[1][1] + " " + prose(2, 30)),
        (2, prose(3, 200)),
        (3, ITEMS[1][1].upper() + "!"),
        (4, "the quick brown fox jumps over the small cat"),
        (5, "before, five short words only here. after"),
        (6, ITEMS[0][1]),
        (7, "too short"),
        (8, prose(4, 5) + " " + " ".join(ITEMS[1][1].split()[:11]) + " " + prose(5, 5)),
        (1, prose(1, 30) + " " + ITEMS[1][1] + " " + prose(2, 30)),
    ]
    got = found(spark, rows)
    assert set(got) == {(1, 2), (3, 2), (5, 3), (6, 1), (8, 2)}
    assert not any(r.refilled for r in got.values())


def test_exact_copies_whatever_their_slots_length_or_case(spark):
    items = [
        (1, "5 km, 8 km, 12 km"),
        (2, "A) Paris B) London C) Rome"),
        (3, "What is the boiling point of water?"),
        (4, "Who taught Anna Karl Berta and Emil Zola to play at Rome and Paris"),
        (5, "Name three rivers"),
    ]
    rows = [
        (1, "the runs were 5 km, 8 km, 12 km long"),
        (2, "choose one: a) Paris b) London c) Rome or none"),
        (3, "Quiz of the week\nWhat is the boiling point of water?\n" + prose(1, 9)),
        (4, items[3][1].upper()),
        (5, items[3][1].lower()),
        (6, "name three rivers"),
        (7, "the runs were 5 km, 8 km, 13 km long; name three lakes"),
    ]
    got = found(spark, rows, items)
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 5)}
    assert not any(r.refilled for r in got.values())


def test_other_names_numbers_and_units(spark):
    asked = "So here it is: Anna has 40 apples and gives 8 apples to Peter Klein. Then Anna walks 7 miles to the old market hall."
    glued = "So here it is: Anna has 40 apples and gives 8 apples to Peter Klein. Then Anna walks 7km to the old market hall."
    got = found(spark, [(1, asked), (2, glued)])
    assert set(got) == {(1, 1), (2, 1)} and all(r.refilled for r in got.values())


def test_number_words_and_inserted_words(spark):
    items = [
        (1, "a farmer sells eggs at the market each day for 12 coins while his brother sells milk to the inn"),
        (2, "when does the last train leave from the old central station towards the harbour on a cold winter sunday"),
        (3, "last spring x paid 5 coins for the ticket while this autumn y paid 5 coins for it"),
    ]
    rows = [(k, items[0][1].replace("12", n)) for k, n in enumerate(["twenty-five", "twenty five", "1 000", "one hundred and five"])]
    words = items[1][1].split()
    rows += [(10, " ".join(words[:9] + ["very"] + words[9:])), (11, " ".join(words[:9] + prose(1, 12).split() + words[9:]))]
    rows += [(20, "last spring x paid 7 coins for the ticket but while this autumn y paid 7 coins for it")]
    rows += [(21, "last spring x paid 7 coins for the ticket but while this autumn y paid 9 coins for it")]
    assert set(found(spark, rows, items)) == {(0, 1), (1, 1), (2, 1), (3, 1), (10, 2), (20, 3)}


def test_numbers_by_value():
    def values(text):
        tokens, fill = dec.template(text)
        return [int(f) for t, f in zip(tokens, fill) if t == dec.NUMBER]

    same = ["25", "twenty five", "Twenty-Five"], ["1000", "1,000", "1 000", "one thousand"], ["105", "one hundred and five"], ["5 million", "5 000 000", "five million"], ["1984", "nineteen eighty-four"]
    for group in same:
        assert len({tuple(values(f"he saw {x} birds")) for x in group}) == 1 and len(values(group[-1])) == 1
    assert [len(values(x)) for x in ("one two three", "5, 100", "12 13", "3 and 5", "twenty, five", "two hundred and five hundred", "1 000 00")] == [3, 2, 2, 2, 2, 2, 2]


def test_inconsistent_fillers_are_another_question(spark):
    items = [(1, "if x costs 5 and y costs 5 then both of them cost 10 in the shop")]
    same = "if x costs 7 and y costs 7 then both of them cost 14 in the shop"
    other = "if x costs 7 and y costs 9 then both of them cost 14 in the shop"
    merged = "if x costs 7 and y costs 7 then both of them cost 7 in the shop"
    assert set(found(spark, [(1, same), (2, other), (3, merged)], items)) == {(1, 1)}


def test_templates():
    tokens, fill = dec.template("He paid 5 dollars, and Mr Smith paid 3.50 euros. Fine.")
    assert [t == dec.NAME for t in tokens] == [False] * 5 + [True] + [False] * 4
    assert (tokens[2], tokens[3], tokens[7], tokens[8]) == (dec.NUMBER, dec.UNIT, dec.NUMBER, dec.UNIT)
    assert (fill != 0).sum() == 5
    assert len(dec.template(" ... -- \n")[0]) <= 1 and len(dec.template("")[0]) == 0


def test_clean_documents_keep_all_columns(spark):
    rows = AWKWARD + [(1, ITEMS[1][1]), (1, "another text with the same id"), (None, ITEMS[1][1])]
    docs = frame(spark, rows)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = dec.clean_documents(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(repr, [*AWKWARD, (1, "another text with the same id")]))
    assert dec.clean_documents(docs.limit(0), benchmark).count() == 0
    assert dec.contaminated(docs, benchmark.limit(0)).count() == 0


def test_windows_of_eight_take_four_steps(monkeypatch):
    from tidemark.llm import shingles

    calls, real = [], shingles.mixed
    monkeypatch.setattr(shingles, "mixed", lambda v: calls.append(1) or real(v))
    tokens = np.random.default_rng(1).integers(0, 5, 4000, np.uint64)
    for size in range(1, 10):
        calls.clear()
        hashes = shingles.window_hashes(tokens, size)
        assert len(calls) <= 1 + (size - 1).bit_length()
        named = {}
        for k, h in enumerate(hashes.tolist()):
            named.setdefault(tuple(tokens[k:k + size].tolist()), set()).add(h)
        assert len(hashes) == 4001 - size and all(len(v) == 1 for v in named.values()) and len(named) == len(set(hashes.tolist()))
    assert not len(shingles.window_hashes(tokens[:7], 8))


def test_plain_words_take_the_short_way_to_the_same_entry(monkeypatch):
    words = ["five", "Five.", "KG", "kg,", "in", "Hello", "hello!", "A", "Straße?", "ŉ", "ǅa", "don't", "x-y", "中文", "."]
    short = [dec.Words()[w] for w in words]
    monkeypatch.setattr(dec, "_special", {w: -1 for w in words})  # were it asked, it would show
    assert dec.Words()["five"] != short[0]
    long = [dec.Words()[w] for w in ["“" + w for w in words]]
    assert short == long
