"""Exact copies, the n-gram join and fuzzy lines against brute force and SQL."""

import random
from itertools import combinations

import pytest

from tests.compare import compare
from tests.llm.conftest import plain
from tidemark.llm import exact_dedup, line_dedup, ngram_join
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.operators.components import connected


@pytest.mark.parametrize("name", ["op2_ngram_join", "op4_exact_dedup"])
def test_queries_equal_sql(spark, duck, folder, name):
    assert compare(spark, duck, folder, name, QUERIES[name], ORACLES[name])[2] is None


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_cycles(spark):
    chance = random.Random(5)
    chain = list(range(1000, 1128))
    chance.shuffle(chain)
    edges = list(zip(chain, chain[1:], strict=False))
    edges += [(1, n) for n in range(2, 60)] + [(200, 201), (201, 202), (202, 200), (300, 300), (7, None)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(plain(connected(df, "a", "b"), "node", "root"))
    real = [(a, b) for a, b in edges if b is not None and a != b]
    assert got == roots({n for e in real for n in e}, real)
    assert connected(df.where("a < 0"), "a", "b").count() == 0


def test_exact_odd_rows(odd):
    got = plain(exact_dedup.exact_groups(odd("_sha")), "doc_id", "keep_id", "group_size", "kept")
    assert got == sorted(
        [
            (1, 1, 3, True), (2, 1, 3, False), (None, 1, 3, False), (3, 3, 1, True), (4, 4, 1, True),
            (5, 5, 4, True), (5, 5, 4, False), (6, 5, 4, False), (None, 5, 4, False),
            (7, 7, 1, True), (8, 8, 1, True),
        ],
        key=repr,
    )
    kept = exact_dedup.drop_exact_copies(odd("_sha"))
    assert kept.columns == odd("_sha").columns
    assert [r[0] for r in plain(kept, "doc_id")] == [1, 3, 4, 5, 7, 8]
    assert exact_dedup.exact_groups(odd(rows=[])).count() == 0


def test_exact_groups_of_null_ids_keep_one(spark):
    df = spark.createDataFrame([(None, "a  b"), (None, "a\tb"), (3, "a b ")], "doc_id long, text string")
    got = plain(exact_dedup.exact_groups(df), "doc_id", "keep_id", "group_size", "kept")
    assert got == [(3, 3, 1, True), (None, None, 2, False), (None, None, 2, True)]


def test_exact_hot_text_spreads_over_salts(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup.exact_groups(df, salts=16)
    assert got.where("keep_id = 1 and group_size = 2000").count() == 2000
    assert got.where("kept").count() == 1001


def brute_sets(texts, words):
    out = {}
    for key, text in texts.items():
        found = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").split(" ") if w]
        n = min(words, len(found))
        out[key] = {tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if n else set()
    return out


def near_copies(seed, count, length, edits):
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = {}
    bases = [[chance.choice(vocabulary) for _ in range(chance.randint(1, length))] for _ in range(12)]
    for i in range(count):
        words = list(chance.choice(bases))
        for _ in range(chance.randint(0, edits)):
            words[chance.randrange(len(words))] = chance.choice(vocabulary)
        if chance.random() < 0.3:
            words = words[: max(1, int(len(words) * chance.uniform(0.85, 1)))]
        texts[i] = " ".join(words)
    return texts


@pytest.mark.parametrize(
    "settings",
    [
        ngram_join.Settings(),
        ngram_join.Settings(block_docs=12, block_grams=700),
        ngram_join.Settings(words=5, percent=80, sampled=3, block_docs=20, broadcast_rows=0),
    ],
)
def test_join_finds_every_link(spark, settings):
    texts = near_copies(11, 260, 120, 4)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    sets = brute_sets(texts, settings.words)
    links = [
        (a, b)
        for a, b in combinations(texts, 2)
        if 100 * len(sets[a] & sets[b]) >= settings.percent * len(sets[a] | sets[b])
    ]
    assert links
    want = roots(texts, links)
    got = plain(ngram_join.similar_components(df, settings=settings), "doc_id", "n_shingles", "component_id")
    assert got == sorted([(k, len(sets[k]), want[k]) for k in texts], key=repr)
    kept = ngram_join.keep_one_of_each(df, settings=settings)
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(set(want.values()))


def test_join_odd_rows(odd):
    got = plain(ngram_join.similar_components(odd("mark")), "doc_id", "n_shingles", "component_id")
    assert got == sorted(
        [
            (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 5, 4), (5, 4, 5), (5, 4, 5), (6, 4, 5), (None, 4, 5),
            (None, 0, None), (7, 1, 7), (8, 5, 8),
        ],
        key=repr,
    )
    kept = ngram_join.keep_one_of_each(odd("_own"))
    assert kept.columns == odd("_own").columns
    assert [r[0] for r in plain(kept, "doc_id")] == [1, 2, 3, 4, 5, 5, 7, 8, None]
    assert ngram_join.similar_components(odd(rows=[])).count() == 0


def test_block_product_of_two_sides():
    import numpy as np

    grams = [np.array(g, np.int64) for g in ([1, 2, 3], [1, 2, 3, 4], [9, 8], [9, 8], [1, 2, 3])]
    sizes = np.array([len(g) for g in grams], float)
    assert ngram_join.links_in_block(grams, sizes, 75, None) == [(0, 1), (0, 4), (2, 3)]
    left = np.array([True, True, True, False, False])
    assert ngram_join.links_in_block(grams, sizes, 75, left) == [(0, 4), (0, 1), (2, 3)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]



def line_key_sets(spark, lines):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(list(enumerate(lines)), "node long, norm string").withColumn("chars", F.length("norm"))
    keys = [set() for _ in lines]
    for node, key in plain(line_dedup.line_keys(line_dedup.line_minima(df)), "node", "key"):
        keys[node].add(key)
    return keys


def test_fuzzy_lines_against_all_pairs(spark):
    chance = random.Random(2)
    words = [chance.choice("bcdfghklm") + chance.choice("aeiou") * chance.randint(1, 3) + str(i) for i in range(80)]
    words = [w.translate(str.maketrans("0123456789", "qwrtpsdfgh")) for w in words]
    bases = [[chance.choice(words) for _ in range(chance.choice([3, 12, 30, 60]))] for _ in range(14)]
    rows = []
    for doc in range(40):
        lines = []
        for _ in range(6):
            line = list(chance.choice(bases))
            if chance.random() < 0.5:
                place = chance.randrange(len(line))
                line[place] = line[place] + chance.choice("xyz")
            text = " ".join(line)
            lines.append(text.upper() + "!" if chance.random() < 0.3 else text)
        rows.append((doc, "\n".join([*lines, "", "--"])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    places = [(d, n, t) for d, text in rows for n, t in enumerate(text.split("\n"))]
    norm = {(d, n): " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) for d, n, t in places}
    lines = sorted(set(norm.values()) - {""})
    alike = [(a, b) for a, b in combinations(lines, 2) if distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9]
    keys = dict(zip(lines, line_key_sets(spark, lines), strict=True))
    assert alike
    got = plain(line_dedup.line_groups(df), "doc_id", "line_no", "keep_id", "keep_line", "kept")
    assert [r[:2] for r in got] == sorted(norm, key=repr)
    keep = {(d, n): (i, k) for d, n, i, k, _ in got}
    assert all(kept == ((d, n) == (i, k)) for d, n, i, k, kept in got)
    assert all(keep[place] == place for place, line in norm.items() if not line)
    # Only lines that edit similarity connects share a group, and its first line stays.
    true_group = roots(lines, alike)
    for place, line in norm.items():
        if line:
            assert true_group[norm[keep[place]]] == true_group[line] and keep[place] <= place
    group = {norm[place]: keep[place] for place in norm if norm[place]}
    assert all(group[norm[place]] == keep[place] for place in norm if norm[place])
    # Lines that are alike and share a key are together, and so are nearly all that are alike.
    assert all(group[a] == group[b] for a, b in alike if keys[a] & keys[b])
    assert sum(group[a] == group[b] for a, b in alike) >= 0.9 * len(alike)
    want = got
    cleaned = dict(plain(line_dedup.drop_repeated_lines(df), "doc_id", "text"))
    for doc, text in rows:
        kept = [t for n, t in enumerate(text.split("\n")) if (doc, n, doc, n, True) in want]
        assert cleaned[doc] == "\n".join(kept)


def test_long_lines_are_compared_by_edits(spark):
    words = [f"v{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000)]
    same = " ".join(words)
    other = " ".join([*words[:-1], "changed"])
    df = spark.createDataFrame([(1, same), (2, other), (3, " ".join(words[::-1]))], "doc_id long, text string")
    assert dict(plain(line_dedup.line_groups(df), "doc_id", "keep_id")) == {1: 1, 2: 1, 3: 3}


def test_lines_odd_rows(odd):
    got = plain(line_dedup.line_groups(odd("norm")), "doc_id", "line_no", "keep_id", "kept")
    assert (2, 0, 2, True) in got and (3, 1, 3, True) in got
    assert (5, 0, 5, True) in got and (6, 0, 5, False) in got and (None, 0, 5, False) in got
    assert not [r for r in got if r[0] == 1]
    cleaned = line_dedup.drop_repeated_lines(odd("_gone"))
    assert cleaned.columns == odd("_gone").columns
    texts = plain(cleaned, "doc_id", "text")
    assert (6, "") in texts and (1, None) in texts and (5, "one two three four five six") in texts
    assert line_dedup.line_groups(odd(rows=[])).count() == 0


@pytest.mark.parametrize("most", [0, 100])
def test_dropped_rows_with_and_without_broadcast(odd, most):
    from pyspark.sql import functions as F

    from tidemark.llm.rowwise import drop_rows

    df = odd("_own")
    gone = df.where("doc_id = 5 or doc_id is null").select("doc_id", "lang")
    left = drop_rows(df, [F.col("doc_id"), F.col("lang")], gone, most)
    assert left.columns == df.columns
    assert [r[0] for r in plain(left, "doc_id")] == [1, 2, 3, 4, 6, 7, 8]


def alike_lines(a, b):
    return distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9


def line_partition(spark, lines, settings=None):
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    return dict(plain(line_dedup.line_groups(df, settings=settings), "doc_id", "keep_id"))


def test_line_candidates_recall_against_all_pairs(spark):
    chance = random.Random(7)
    words = ["".join(chance.choice("abcdefghijklmnop") for _ in range(chance.randint(2, 9))) for _ in range(500)]
    lines = []
    for n in (2, 5, 9, 15, 30, 45):
        for _ in range(16):
            line = [chance.choice(words) for _ in range(n)]
            lines.append(" ".join(line))
            for _ in range(2):
                copy = list(line)
                for place in chance.sample(range(n), max(1, n // 8)):
                    copy[place] = chance.choice(words)
                lines.append(" ".join(copy))
    lines = sorted(set(lines))
    links = [(a, b) for a, b in combinations(range(len(lines)), 2) if 4 * len(lines[a]) <= 5 * len(lines[b]) and 4 * len(lines[b]) <= 5 * len(lines[a]) and alike_lines(lines[a], lines[b])]
    keys = line_key_sets(spark, lines)
    met = sum(bool(keys[a] & keys[b]) for a, b in links)
    assert len(links) > 80 and met >= 0.97 * len(links)
    got = line_partition(spark, lines)
    assert sum(got[a] == got[b] for a, b in links) >= 0.97 * len(links)
    want = roots(range(len(lines)), links)
    assert all(want[a] == want[b] for a, b in got.items())


def test_lines_of_one_crowd_are_linked_to_each_other(spark):
    # All lines are of the same words, so they share a SimHash; two of each order are alike.
    chance = random.Random(8)
    words = ["".join(chance.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(40)]
    lines = []
    for _ in range(60):
        order = words[:]
        chance.shuffle(order)
        lines.append(" ".join(order))
        order[3], order[4] = order[4], order[3]
        lines.append(" ".join(order))
    want = {n: n - n % 2 for n in range(len(lines))}
    assert line_partition(spark, lines) == want
    # One long common part makes a crowd of lines that differ in the rest.
    common = " ".join(words[:25])
    lines = []
    for _ in range(60):
        rest = ["".join(chance.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(12)]
        lines += [common + " " + " ".join(rest), common + " " + " ".join([*rest[:-1], "xyzxyz"])]
    assert line_partition(spark, lines, line_dedup.Settings(crowd=4)) == want


@pytest.mark.parametrize("block", [7, 1000])
def test_every_pair_of_a_crowd_is_compared(spark, monkeypatch, block):
    from pyspark.sql import functions as F

    # One key for all lines: no other key splits the crowd, and its hub is alike to few.
    monkeypatch.setattr(line_dedup, "line_keys", lambda minima: minima.select(
        "node", "chars", F.lit(5).cast("long").alias("key")
    ).distinct())
    chance = random.Random(10)
    lines = []
    for _ in range(40):
        line = "".join(chance.choice("abcdefghijklmnop") for _ in range(60))
        lines += [line, line[:30] + "zz" + line[32:], line[:10] + "yyyy" + line[14:]]
    links = [(a, b) for a, b in combinations(range(len(lines)), 2) if alike_lines(lines[a], lines[b])]
    want = roots(range(len(lines)), links)
    assert line_partition(spark, lines, line_dedup.Settings(crowd=4, block=block)) == want


def test_long_lines_are_compared_by_edits(spark):
    chance = random.Random(9)
    words = ["".join(chance.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(500)]
    changed = [("q" * 6 if i % 20 == 7 else w) for i, w in enumerate(words)]
    far = [("q" * 6 if i % 3 == 1 else w) for i, w in enumerate(words)]
    lines = [" ".join(w) for w in (words, changed, far)]
    assert min(map(len, lines)) > 2000
    assert line_partition(spark, lines) == {0: 0, 1: 0, 2: 2}
    for _ in range(300):
        a, b = ("".join(chance.choice("ab ü") for _ in range(chance.randint(0, 40))) for _ in range(2))
        budget = chance.randint(0, 20)
        assert line_dedup.edits_within(a, b, budget) == (distance(a, b) <= budget)


def test_hot_lines_are_combined_before_the_shuffle(spark, monkeypatch):
    lines = ["the same line in very many rows"] * 30 + ["the same line in very many rowz", "something else altogether"]
    want = line_partition(spark, lines)
    assert want == {**dict.fromkeys(range(31), 0), 31: 31}
    monkeypatch.setattr(line_dedup, "hot_keys", lambda df, keys: [
        r[0] for r in df.where("norm like '%rows'").selectExpr("xxhash64(node)").distinct().collect()
    ])
    assert line_partition(spark, lines) == want


def test_minima_of_a_line_in_pieces(spark):
    from pyspark.sql import functions as F

    chance = random.Random(4)
    texts = ["".join(chance.choice("abcdeü") for _ in range(n)) for n in (28, 261, 262, 700)]
    df = spark.createDataFrame(list(enumerate(texts)), "node long, norm string").withColumn("chars", F.length("norm"))
    grams = {(n, t[i : i + 6]) for n, t in enumerate(texts) for i in range(len(t) - 5)}
    hashed = spark.createDataFrame(sorted(grams), "node long, gram string").selectExpr("node", "xxhash64(gram) as h")
    want: dict[int, dict[int, int]] = {}
    for node, h in hashed.collect():
        slots = want.setdefault(node, {})
        slot, least = h % line_dedup.SLOTS, (h & (2**64 - 1)) >> 40
        slots[slot] = min(slots.get(slot, least), least)
    got = dict(plain(line_dedup.line_minima(df).where("q = 6"), "node", "minima"))
    assert {n: [s << 24 | m for s, m in sorted(v.items())] for n, v in want.items()} == got


@pytest.mark.parametrize("letters", ["abcde", "abcdeü漢"])
def test_grams_of_ascii_by_bytes_and_of_others_by_pieces(spark, letters):
    from pyspark.sql import functions as F

    chance = random.Random(5)
    texts = ["".join(chance.choice(letters) for _ in range(n)) for n in (1, 2, 11, 12, 30, 400, 4101, 4102, 9000)]
    df = spark.createDataFrame(list(enumerate(texts)), "node long, norm string").withColumn("chars", F.length("norm"))
    widths = [(w, least, most) for w, _, least, most in line_dedup.WIDTHS]
    grams = [
        (n, w, t[i : i + w])
        for n, t in enumerate(texts) for w, least, most in widths if least <= len(t) < most
        for i in range(max(len(t) - w + 1, 1))
    ]
    want = spark.createDataFrame(grams, "node long, q int, gram string").selectExpr("node", "q", "xxhash64(gram) h")
    got = line_dedup._grams(df)
    assert plain(got, "node", "q", "gram") == plain(want, "node", "q", "h")


def test_keys_of_a_line_are_distinct_without_a_shuffle(spark):
    repeated = spark.createDataFrame(
        [(1, 9, 2, [5, 5, 5, 5]), (2, 40, 6, [7 << 24 | 3])], "node long, chars int, q int, minima array<int>"
    )
    keys = line_dedup.line_keys(repeated)
    assert len(plain(keys, "node", "key")) == len(set(plain(keys, "node", "key"))) == 2
    assert "Exchange" not in keys._jdf.queryExecution().executedPlan().toString()


def test_short_lines_and_lines_without_spaces_are_compared(spark):
    lines = [
        "terms of service", "terms of servise", "privacy", "privacie", "subscribe now", "subscribe mow",
        "漢字文本去重需要比較每一行的內容", "漢字文本去重需要比较每一行的內容", "cat", "dog", "全然違う行です",
    ]
    assert line_partition(spark, lines) == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6, 8: 8, 9: 9, 10: 10}


def test_a_form_leaves_out_only_what_minima_leave_out(spark):
    from pyspark.sql import functions as F

    chance = random.Random(12)
    base = ["".join(chance.choice("abcdef") for _ in range(n)) for n in (28, 60, 300, 900)]
    texts = [t[:i] + "zz" * i + t[i:] for t in base for i in (0, 1, 9, 25)]
    df = spark.createDataFrame(list(enumerate(texts)), "node long, norm string").withColumn("chars", F.length("norm"))
    found = line_dedup.line_minima(df).where("q = 6").select("node", "minima", "form").checkpoint()
    one, other = found.toDF("a", "m", "f"), found.toDF("b", "n", "g")
    rows = one.crossJoin(other).select("m", "n", line_dedup._unlike(F.col("f"), F.col("g"), line_dedup.Settings())).collect()
    assert any(unlike for _, _, unlike in rows)
    assert all(len(set(m) & set(n)) < 0.18 * max(len(m), len(n)) for m, n, unlike in rows if unlike)
    # A byte of 127 values tells nearly all different minima apart.
    apart = [unlike for m, n, unlike in rows if len(set(m) & set(n)) < 0.1 * max(len(m), len(n))]
    assert sum(apart) >= 0.9 * len(apart)


def test_alike_lines_are_joined_up_by_few_alignments(spark, monkeypatch):
    aligned = []
    alike = line_dedup._alike
    monkeypatch.setattr(line_dedup, "_alike", lambda pairs, settings: aligned.append(pairs.count()) or alike(pairs, settings))
    chance = random.Random(13)
    base = "".join(chance.choice("abcdefghijklmnop") for _ in range(120))
    lines = [base[:i] + "zz" + base[i + 2 :] for i in range(5, 45)]
    assert set(line_partition(spark, lines).values()) == {0}
    # All pairs would be 780.
    assert len(lines) - 1 <= sum(aligned) <= 4 * len(lines)


def test_pairs_are_alike_by_their_edit_distance_on_every_way(spark):
    chance = random.Random(14)

    def text(n):
        return "".join(chance.choice("abcdeü ") for _ in range(n)).replace(" ", "x")

    rows = []
    for n in (1, 5, 28, 60, 90, 150):
        for rate in (0, 0.05, 0.15, 0.19, 0.21, 0.25, 1):
            one = text(n)
            other = one[: n // 3] + "".join(
                chance.choice((c, c + "z", "", "y")) if chance.random() < 1.7 * rate else c for c in one[n // 3 :]
            )
            rows += [(one, other), (one, text(n)), (one, one[: n // 2] + text(n - n // 2)), (one + text(n // 9), other)]
    want = [alike_lines(a, b) for a, b in rows]
    assert 40 < sum(want) < len(want) - 40
    df = spark.createDataFrame([(i, -i, a, b) for i, (a, b) in enumerate(rows)], "node long, hub long, one string, other string")
    got = dict(plain(line_dedup._alike(df, line_dedup.Settings()), "node", "alike"))
    assert [got[i] for i in range(len(rows))] == want
    near = line_dedup._near(df.selectExpr("*", "int(floor(0.2 * greatest(length(one), length(other)) + 1e-9)) as budget"))
    assert plain(near, "node", "alike") == sorted(got.items(), key=repr)


def test_minima_of_a_line_are_aggregated_as_numbers(spark):
    df = spark.createDataFrame([(1, "some words of a line that is long enough", 40)], "node long, norm string, chars int")
    plan = line_dedup.line_minima(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_the_conf_of_a_session_stays_after_line_groups(spark, odd):
    before = {key: spark.conf.get(key, None) for key in line_dedup.STEP_CONF}
    assert line_dedup.line_groups(odd()).count() > 0
    assert {key: spark.conf.get(key, None) for key in line_dedup.STEP_CONF} == before
