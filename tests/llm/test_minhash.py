import random
import re
from itertools import combinations

from glotspark.functions.storage import Scratch
from glotspark.llm import minhash
from glotspark.llm.components import components

DDL = "doc_id long, text string, key string, node int"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text):
    words = WORD.findall((text or "").encode().translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent=85):
    sets = {row[0]: shingles(row[1]) for row in rows}
    group = {doc: doc for doc in sets}

    def find(doc):
        while group[doc] != doc:
            doc = group[doc]
        return doc

    for a, b in combinations(sorted(sets), 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if both and 100 * both >= percent * either:
            low, high = sorted((find(a), find(b)))
            group[high] = low
    return {doc: (len(sets[doc]), find(doc), find(doc) == doc) for doc in sets}


def run(spark, rows):
    with Scratch(spark) as scratch:
        found = minhash.near_duplicates(spark.createDataFrame(rows, DDL), scratch).collect()
    return {row.doc_id: (row.n_shingles, row.component_id, row.kept) for row in found}


def edits(draw, words, count):
    words = list(words)
    for _ in range(count):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return " ".join(words)


def test_equals_brute_force(spark):
    draw = random.Random(1)
    base = [f"b{draw.randrange(5000)}" for _ in range(150)]
    texts = [" ".join(base), " ".join(base).upper(), "\t".join(base), None, "", " \n ", "One two"]
    texts += ["one  TWO", "one two three four five", "one two three four"]
    # Likenesses on both sides of the limit, and chains of links.
    texts += [edits(draw, base, draw.randint(1, 9)) for _ in range(120)]
    chain = list(base)
    for _ in range(12):
        chain = edits(draw, chain, 2).split()
        texts.append(" ".join(chain))
    rows = [(i, text, "k", 1) for i, text in enumerate(texts)]
    assert run(spark, rows) == brute(rows)


def test_hot_bucket_in_blocks(spark, monkeypatch):
    """Many texts that are alike but not enough: no pair is lost where blocks meet."""
    monkeypatch.setattr(minhash, "GROUP", 8)
    draw = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, edits(draw, base, 4), "k", 1) for i in range(90)]
    rows += [(100 + i, edits(draw, rows[i][1].split(), 1), "k", 1) for i in range(0, 90, 7)]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, "a b c d e f", None, None), (5, "a b c d e f", None, None)]
    rows += [(5, "x y z u v w", None, None), (7, "x y z u v w", None, None), (8, None, None, None)]
    with Scratch(spark) as scratch:
        df = spark.createDataFrame(rows, DDL)
        got = minhash.near_duplicates(df, scratch).collect()
        assert len(got) == len(rows)
        assert {(r.doc_id, r.component_id, r.kept) for r in got if r.doc_id in (7, 8)} == {
            (7, 5, False),
            (8, 8, True),
        }
        assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
        assert minhash.near_duplicates(spark.createDataFrame([], DDL), scratch).count() == 0


def test_components_of_long_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + i) for i in range(1, 60)]
    links += [(7, 7), (1, 2), (2, 1)]
    with Scratch(spark) as scratch:
        got = components(spark.createDataFrame(links, "a long, b long"), scratch).collect()
    found = {row.node: row.component for row in got}
    assert all(found[i] == 100 for i in range(100, 141))
    assert all(found[500 + i] == 500 for i in range(60))
    assert found[1] == found[2] == 1 and 7 not in found


def test_other_limits_equal_brute_force(spark):
    """The bands follow the limit: 40 of 8 values would miss half of the pairs at 60."""
    draw = random.Random(9)
    for percent, count in ((60, 4), (80, 2)):
        rows = []
        for i in range(0, 400, 2):
            base = [f"b{i}x{j}" for j in range(95)]
            rows += [(i, " ".join(base), "k", 1), (i + 1, edits(draw, base, count), "k", 1)]
        sets = [shingles(row[1]) for row in rows]
        likeness = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2])]
        assert sum(percent <= 100 * each < percent + 5 for each in likeness) > 60
        with Scratch(spark) as scratch:
            found = minhash.near_duplicates(spark.createDataFrame(rows, DDL), scratch, percent=percent)
            kept = {r.doc_id: r.kept for r in found.collect()}
        # Different pairs share no words, so a brute force over the pairs is one over all texts.
        assert all(kept[i] for i in range(0, 400, 2))
        assert [not kept[i] for i in range(1, 400, 2)] == [100 * x >= percent for x in likeness]


def test_bands_of_every_limit():
    for percent in range(10, 101):
        bands, rows = minhash.banding(percent)
        assert bands * rows <= 2 * minhash.PERMUTATIONS
        assert (1 - (percent / 100) ** rows) ** bands <= minhash.MISSED
    assert minhash.banding(85) == (40, 8) and minhash.banding(80) == (53, 6)


def rows_brute(rows, percent):
    """The component of every row, rows being nodes: ids may repeat."""
    sets = [shingles(row[1]) for row in rows]
    group = list(range(len(rows)))

    def find(row):
        while group[row] != row:
            row = group[row]
        return row

    for a, b in combinations(range(len(rows)), 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if both and 100 * both >= percent * either:
            group[find(b)] = find(a)
    least = {}
    for row, node in enumerate(map(find, range(len(rows)))):
        least[node] = min(least.get(node, rows[row][0]), rows[row][0])
    return [(rows[row][0], len(sets[row]), least[find(row)]) for row in range(len(rows))], [
        find(row) if sets[row] else None for row in range(len(rows))
    ]


def repeated_ids():
    draw = random.Random(12)
    text = "one passage of text that two rows of other ids hold with a word more or less".split()
    other = "what this row says stands nowhere else in the table at all".split()
    rows = [(1, " ".join(text * 3)), (5, " ".join(text * 3) + " more"), (5, " ".join(other))]
    base = [f"b{i}" for i in range(120)]
    for _ in range(120):
        start = draw.choice([base, base[::-1], [f"c{draw.randrange(10**6)}" for _ in range(60)]])
        rows.append((draw.randrange(20), edits(draw, start, draw.randint(0, 6))))
    rows += [rows[7]] * 5 + [(2, None), (2, ""), (2, None)]
    return [(*row, "k", 1) for row in rows]


def test_rows_of_one_id_are_placed_by_their_own_text(spark):
    rows = repeated_ids()
    for percent in (85, 80):
        want, _ = rows_brute(rows, percent)
        with Scratch(spark) as scratch:
            df = spark.createDataFrame(rows, DDL)
            got = minhash.near_duplicates(df, scratch, percent=percent).collect()
        key = lambda row: (*row, row[0] == row[2])
        assert sorted(map(tuple, got)) == sorted(map(key, want))


def test_one_row_of_every_component_stays(spark):
    rows = repeated_ids() + [(None, "a b c d e f", "k", 1)] * 2
    want, nodes = rows_brute(rows[:-2], 80)
    with Scratch(spark) as scratch:
        df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, node int")
        kept = minhash.keep_one(df, scratch, percent=80)
        assert kept.columns == df.columns
        got = [tuple(row) for row in kept.collect()]
    assert set(got) <= set(rows)
    of_text = {row[:2]: node for row, node in zip(rows, nodes)}
    places = [of_text[row[:2]] for row in got if row[0] is not None and shingles(row[1])]
    assert len(places) == len(set(places)) and set(places) == {n for n in nodes if n is not None}
    least = {node: row[2] for row, node in zip(want, nodes)}
    assert all(row[0] == least[of_text[row[:2]]] for row in got if of_text.get(row[:2]) is not None)
    assert sum(row[0] is None for row in got) == 2
    assert sum(not shingles(row[1]) for row in got) == 3
    assert (5, rows[2][1], "k", 1) in got
