import random

import pytest
from pyspark.sql import functions as F

from tablesift import match_names, match_names_plain, search_company_names
from tablesift.functions import scorers
from tablesift.functions.text import clean_suffix, company_suffixes, letters_only, normalize_name
from tablesift.operators.name_pairs import qualifying_pairs
from tablesift.operators.names import block_columns


def names(spark, *rows):
    return spark.createDataFrame(list(rows), "name string, entity_id string")


def searches(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "q string")


def result(df):
    return {r.Search_string: (r.BestMatch, round(r.Score, 3), r.entity_id) for r in df.collect()}


def test_scores():
    assert scorers.weighted_ratio("betta", "beta") == pytest.approx(88.888, abs=1e-2)
    assert scorers.token_sort_ratio("limited acme", "acme limited") == 100
    assert scorers.token_set_ratio("acme", "acme limited") == 100
    assert scorers.partial_ratio("beta", "the beta group") == 100
    assert scorers.lcs_length("betta", "beta") == 4
    assert scorers.quick_ratio("", "") == 0 and scorers.ratio("", "") == 100
    with pytest.raises(ValueError, match="token_ratio"):
        scorers.resolve_scorer("nope")


def test_exact_after_suffix(spark):
    ref = names(spark, ("Acme Ltd", "E1"), ("Other Corp", "E2"))
    out = match_names(searches(spark, "ACME LTD"), ref, "name", "entity_id", 90, ["ltd"]).collect()
    assert [tuple(r) for r in out] == [("acme", "acme", 100.0, "Acme Ltd", "E1")]


def test_fuzzy_and_unmatched(spark):
    ref = names(spark, ("Acme Limited", "E1"), ("Acme Services", "E2"), ("Beta Group", "E3"))
    got = result(match_names(searches(spark, "acme limted", "acme servics", "unknown entity"), ref, "name", "entity_id", 70))
    assert got["acme limted"][2] == "E1" and got["acme servics"][2] == "E2"
    assert got["unknown entity"] == (None, 0.0, None)


def test_later_tier(spark):
    ref = names(spark, ("Acme Limited", "E1"), ("Zebra Services", "E2"))
    assert result(match_names(searches(spark, "zcme limited"), ref, "name", "entity_id", 80))["zcme limited"][2] == "E1"
    got = match_names(searches(spark, "limited acme"), ref, "name", "entity_id", 90, scorer="token_sort_ratio")
    assert result(got)["limited acme"][2] == "E1"


def test_plain(spark):
    ref = names(spark, ("acme", "E1"), ("beta", "E2"))
    got = result(match_names_plain(searches(spark, "acme", "betta", "unknown"), ref, "name", "entity_id", 80))
    assert got == {"acme": ("acme", 100.0, "E1"), "betta": ("beta", 88.889, "E2"), "unknown": (None, 0.0, None)}
    ref = names(spark, ("Acme A/S", "E1"), ("Beta ApS", "E2"))
    assert result(match_names_plain(searches(spark, "Acme"), ref, "name", "entity_id", 80, suffixes=["A/S"])) == {
        "acme": ("acme", 100.0, "E1")}
    ref = names(spark, ("Acme Ltd", "E1"))
    assert result(match_names_plain(searches(spark, "acme"), ref, "name", "entity_id", 80, remove=[" ltd"])) == {
        "acme": ("acme", 100.0, "E1")}


def test_plain_order_and_ties(spark):
    ref = names(spark, ("acme a", "E3"), ("acme b", "E1"), ("acme b", "E2"))
    q = searches(spark, "acme", "acme b")
    first = result(match_names_plain(q, ref, "name", "entity_id", 60, scorer="ratio"))
    assert first["acme"][2] == "E1" and first["acme b"][2] == "E2"
    every = match_names_plain(q, ref, "name", "entity_id", 60, scorer="ratio", ties="all").collect()
    assert sorted(r.entity_id for r in every if r.Search_string == "acme") == ["E1", "E2", "E3"]


def test_company_search_keeps_ties(spark):
    ref = names(spark, ("Nordic Steel 1 Inc", "E1"), ("Nordic Steel 2 Inc", "E2"), ("Other", "E3"))
    got = search_company_names(searches(spark, "Nordic Steel 3"), ref).collect()
    assert sorted(r.entity_id for r in got) == ["E1", "E2"]


def test_callable_scorer_needs_a_guard(spark):
    ref = names(spark, ("acme one", "E1"), ("acme two", "E2"))
    q = searches(spark, "acme onn")
    with pytest.raises(ValueError, match="guard"):
        match_names(q, ref, "name", "entity_id", 90, scorer=lambda a, b: 95.0)
    got = match_names(q, ref, "name", "entity_id", 90, scorer=lambda a, b: 95.0, guard=("ratio", 80))
    assert [r.entity_id for r in got.collect()] == ["E1"]


WORDS = ["acme", "limited", "group", "nord", "bank", "of", "the", "x", "inc", "öl", "holding", "a", "日本", "𝒳 corp", "steel"]


def some_names(rnd, n):
    out = set()
    for _ in range(n):
        chars = list(" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 4))))
        for _ in range(rnd.randint(0, 2)):
            i = rnd.randrange(len(chars))
            chars[i:i + rnd.randint(0, 1)] = rnd.choice("abc ")
        out.add(" ".join("".join(chars).split()) or "q")
    return sorted(out)


@pytest.mark.parametrize("scorer,cut_off", [
    ("ratio", 55), ("ratio", 80), ("ratio", 90), ("ratio", 95), ("token_sort_ratio", 95), ("WRatio", 60), ("WRatio", 90.1), ("partial_ratio", 75),
    ("token_sort_ratio", 80), ("token_set_ratio", 85), ("token_ratio", 70), ("QRatio", 100)])
def test_keys_find_every_qualifying_pair(spark, scorer, cut_off):
    rnd = random.Random(cut_off)
    left, right = some_names(rnd, 40), some_names(rnd, 120)
    got = {(r.search, r.name): r.score for r in qualifying_pairs(
        spark.createDataFrame([(x,) for x in left], "search string"),
        spark.createDataFrame([(x,) for x in right], "name string"), scorer, cut_off, direct_pairs=0).collect()}
    fn = scorers.SCORERS[scorer]
    assert got == {(a, b): fn(a, b) for a in left for b in right if fn(a, b) >= cut_off}


@pytest.mark.parametrize("scorer,cut_off", [("ratio", 80), ("ratio", 92), ("token_sort_ratio", 85), ("QRatio", 97)])
def test_segments_find_every_qualifying_pair(spark, monkeypatch, scorer, cut_off):
    monkeypatch.setattr("tablesift.operators.name_pairs.KEY_COST", 0)
    test_keys_find_every_qualifying_pair(spark, scorer, cut_off)


@pytest.mark.parametrize("scorer,cut_off", [("ratio", 80), ("token_sort_ratio", 75), ("WRatio", 80)])
def test_blocks_give_the_same_pairs(spark, monkeypatch, scorer, cut_off):
    monkeypatch.setattr("tablesift.operators.name_pairs.BROADCAST_BYTES", -1)
    test_keys_find_every_qualifying_pair(spark, scorer, cut_off)


def tiers(search, refs):
    """The tiers of one search name, by direct comparison with every name."""
    def key(s, n):
        return "".join(c for c in s.lower() if c.isascii() and c.isalnum())[:n]

    def toks(s):
        return {t for t in s.split() if len(t) > 1}

    tol = max(3, min(10, -(-len(search) // 3)))
    out = []
    for block in (
        [r for r in refs if key(search, 3) and key(r, 3) == key(search, 3)],
        [r for r in refs if toks(r) & toks(search)],
        [r for r in refs if key(search, 1) and key(r, 1) == key(search, 1)],
        list(refs),
    ):
        near = [r for r in block if abs(len(r) - len(search)) <= tol]
        out.append(near or block)
    return out + [list(refs)]


@pytest.mark.parametrize("scorer,cut_off", [("WRatio", 65), ("token_set_ratio", 70), ("ratio", 60)])
def test_tiers_match_direct_search(spark, scorer, cut_off):
    rnd = random.Random(11)
    refs, qs = some_names(rnd, 100), some_names(rnd, 40)
    got = {}
    for r in match_names(searches(spark, *qs), names(spark, *[(x, x) for x in refs]), "name", "entity_id", cut_off, scorer=scorer).collect():
        got.setdefault(r.Search_string, set()).add((r.BestMatch, r.Score))
    fn, want = scorers.SCORERS[scorer], {}
    for q in qs:
        if q in refs:
            want[q] = {(q, 100.0)}
            continue
        want[q] = {(None, 0.0)}
        for tier in tiers(q, refs):
            best = max((fn(q, r) for r in tier), default=0)
            if best >= cut_off:
                want[q] = {(r, best) for r in tier if fn(q, r) == best}
                break
    assert got == want


def test_text_columns(spark):
    df = spark.createDataFrame([("Abc-123!",), (None,), ("  Æble & Co. ",), ("cisco",), ("Ltd",)], "v string")
    keys = [r.k for r in df.select(letters_only(F.col("v")).alias("k")).collect()]
    assert keys[:2] == ["abc123", None]
    norm = [r.k for r in df.select(normalize_name(F.col("v"), ["co", "ltd"]).alias("k")).collect()]
    assert norm == ["abc 123", None, "æble", "cis", None]
    whole = [r.k for r in df.select(normalize_name(F.col("v"), ["co", "ltd"], word_boundary=True).alias("k")).collect()]
    assert whole[3] == "cisco"
    b = spark.range(1).select(F.lit("a b acme").alias("n")).select(*[c.alias(k) for k, c in block_columns(F.col("n")).items()]).first()
    assert (b.prefix3, b.prefix1, b.name_len, b.tokens) == ("aba", "a", 8, ["acme"])
    assert len(company_suffixes()) == 46 and clean_suffix("s.a.") == "s a"


@pytest.mark.parametrize("scorer,cut_off", [("WRatio", 65), ("token_set_ratio", 70), ("ratio", 60), ("ratio", 85)])
def test_stages_change_no_result(spark, monkeypatch, scorer, cut_off):
    from tablesift.operators import names as module

    rnd = random.Random(12)
    refs, qs = some_names(rnd, 100), some_names(rnd, 60)
    ref = names(spark, *[(x, x) for x in refs])
    out = []
    for direct, gain in ((10**9, 20), (0, 0), (0, 20)):  # no stages, all stages, those predicted to be cheap
        monkeypatch.setattr(module, "STAGE_GAIN", gain)
        got = match_names(searches(spark, *qs), ref, "name", "entity_id", cut_off, scorer=scorer, direct_pairs=direct)
        out.append(sorted((r.Search_string, r.BestMatch or "", r.Score) for r in got.collect()))
    assert out[0] == out[1] == out[2]


def test_joins_emit_a_tenth_of_all_pairs(spark):
    from tablesift.operators import name_pairs as module

    from tablesift.plans.data import page_titles

    refs = sorted({r.name.lower() for r in page_titles(spark, "/root/testdata/sf0.01").collect()})
    left = spark.createDataFrame([(r[:3] + r[4:],) for r in refs], "search string")
    right = spark.createDataFrame([(r,) for r in refs], "name string")
    a, b = module.stage_keys(left.withColumn("in_band", F.array(F.lit("prefix3"))), right, "prefix3")
    assert module.predicted_rows(a, b, ["key", "tile"]) == a.join(b, ["key", "tile"]).count() <= len(refs) ** 2 / 10
    assert "tile" in a.join(b, ["key", "tile"])._jdf.queryExecution().executedPlan().toString()
    c, e = module.segment_keys(left, right, "ratio", 90)
    found = module.segment_pairs(c, e, 90)
    assert found.count() <= len(refs) ** 2 / 10
    want = {(x, y) for x in [r[:3] + r[4:] for r in refs] for y in refs if scorers.ratio(x, y) >= 90}
    got = {(r.search, r.name) for r in found.collect()}
    assert want <= got


def test_tiles_hold_each_pair_once(spark, monkeypatch):
    from collections import Counter

    from tablesift.operators import name_pairs as module

    monkeypatch.setattr(module, "BLOCK", 16)
    left = spark.createDataFrame([(f"s{k}",) for k in range(70)], "search string")
    right = spark.createDataFrame([(f"n{k}",) for k in range(150)], "name string")
    for limit in (10**9, -1):
        monkeypatch.setattr(module, "BROADCAST_BYTES", limit)
        got = Counter((r.search, r.name) for r in module.tile_pairs(left, right, lambda a, b: 50.0, 10).collect())
        assert len(got) == 70 * 150 and set(got.values()) == {1}


def test_array_scores_are_the_plain_scores():
    import numpy as np

    from tablesift.functions import pair_scores

    rnd = random.Random(14)
    texts = [["", " ", "a" * 70 + " b"] + some_names(rnd, 40) + [" ".join(some_names(rnd, 4)) for _ in range(12)] for _ in range(2)]
    a, b = pair_scores.Texts(texts[0]), pair_scores.Texts(texts[1])
    ai, bi = np.repeat(np.arange(len(a.texts)), len(b.texts)), np.tile(np.arange(len(b.texts)), len(a.texts))
    for name, fn in scorers.SCORERS.items():
        want = np.array([fn(a.texts[i], b.texts[j]) for i, j in zip(ai, bi)])
        for floor in (0, 50, 90.1):
            got = pair_scores.pair_scores(name, a, b, ai, bi, floor)
            assert (got == want)[want >= floor].all() and (got[want < floor] < floor).all(), (name, floor)


def test_block_tables_hold_every_pair(monkeypatch):
    import numpy as np

    from tablesift.functions import pair_scores

    rnd = random.Random(15)
    left = ["", " ", "b" * 70 + " a", *some_names(rnd, 30)]
    right = ["", "a" * 70 + " b", "e" * 40, *some_names(rnd, 60), *[" ".join(some_names(rnd, 4)) for _ in range(9)]]
    a, b = pair_scores.Texts(left), pair_scores.Texts(right)
    ai, bi = np.repeat(np.arange(len(left)), len(right)), np.tile(np.arange(len(right)), len(left))
    monkeypatch.setattr(pair_scores, "CELLS", 500)
    want = pair_scores.lcs(a, b, ai, bi).reshape(len(left), len(right))
    assert (pair_scores.lcs_table(a, slice(0, len(left)), b) == want).all()
    assert (pair_scores.shared_table(a, slice(0, len(left)), b) >= want).all()
    for dense in (0, 9):  # by subsequences, by characters
        monkeypatch.setattr(pair_scores, "DENSE", dense)
        for name, fn in scorers.SCORERS.items():
            for floor in (50, 80, 91):
                got = {(i, j): s for x in pair_scores.scored_block(name, a, b, floor) for i, j, s in zip(*x, strict=True)}
                assert got == {(i, j): s for i, x in enumerate(left) for j, y in enumerate(right) if (s := fn(x, y)) >= floor}, (name, floor)


def test_blocks_of_keys_hold_each_pair_of_a_key(spark, monkeypatch):
    from tablesift.operators import name_pairs as module

    monkeypatch.setattr(module, "BLOCK", 8)  # the key "hot" is dealt into blocks, the others share groups
    monkeypatch.setattr(module, "FEW", 20)
    left = [(f"{'s' * (k % 30)}{k}", k % 5 == 0, "hot" if k % 2 else f"k{k % 9}") for k in range(80)]
    right = [(f"{'n' * (k % 17)}{k}", "hot" if k % 3 else f"k{k % 9}") for k in range(70)]
    asked = spark.createDataFrame(left, "search string, whole boolean, key string")
    known = spark.createDataFrame(right, "name string, key string")

    def near(search, name):
        return abs(len(search) - len(name)) <= max(3, min(10, -(-len(search) // 3)))

    found = module.block_pairs(asked, known, ["key"], lambda a, b: 50.0 + len(b), 10, ("partial_ratio", 0))
    got = sorted((r.search, r.name, r.score) for r in found.collect())
    assert got == sorted((s, n, 50.0 + len(n)) for s, w, k in left for n, c in right if k == c and (w or near(s, n)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan  # pairs of blocks, no row for each pair


def test_best_pairs_by_segments_are_the_best(spark, monkeypatch):
    from tablesift.operators import name_pairs as module

    monkeypatch.setattr(module, "KEY_COST", 0)
    rnd = random.Random(16)
    right = sorted({"".join(rnd.choice("abcde ") for _ in range(30)).strip() for _ in range(60)})
    left = [r[:7] + r[8:] for r in right[:20]] + [r[2:-2] for r in right[20:40]] + ["q"]
    for scorer in ("ratio", "WRatio", "token_sort_ratio"):
        fn = scorers.SCORERS[scorer]
        found = module.best_pairs(spark.createDataFrame([(x,) for x in left], "search string"),
                                  spark.createDataFrame([(x,) for x in right], "name string"), scorer, 70, direct_pairs=0).collect()
        best = {}
        for r in found:
            assert r.score == fn(r.search, r.name)
            best[r.search] = max(best.get(r.search, 0), r.score)
        got = {(r.search, r.name) for r in found if r.score == best[r.search]}
        want = {(s, n) for s in left for n in right if fn(s, n) >= 70 and fn(s, n) == max(fn(s, m) for m in right)}
        assert got == want


def test_full_word_sets_need_no_pairs_of_all(spark, monkeypatch):
    from tablesift.operators import names as operator

    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 6))) for _ in range(60)]
    rows = [("the of " + " ".join(rng.sample(words, rng.randint(1, 4))), f"E{k}") for k in range(120)]
    rows += [("the of", "E120"), ("the", "E121"), ("xyz quite other", "E122"), ("ab", "E123")]
    asked = [" ".join(reversed(n.split())) for n, _ in rows] + ["the of " + words[0][:-1] + " " + words[1], "xyz quit other", "no such thing", "x the"]
    compared = []
    every = operator.qualifying_pairs

    def counted(searches, *rest):
        compared.append(searches.count())
        return every(searches, *rest)

    monkeypatch.setattr(operator, "qualifying_pairs", counted)
    monkeypatch.setattr(operator, "KEY_COST", 1, raising=False)
    for scorer in ("token_set_ratio", "token_ratio"):
        def found(direct, scorer=scorer):
            out = match_names(searches(spark, *asked), names(spark, *rows), "name", "entity_id", 85, scorer=scorer, direct_pairs=direct)
            return sorted(map(str, out.collect()))

        staged, direct = found(0), found(10**9)
        assert staged == direct and len(staged) >= len(asked)
        # all words of the reordered names are in a name, so they are not compared with all names
        assert compared[-2] < 8 < compared[-1]


def test_few_windows_are_scored(monkeypatch):
    from tablesift.functions import pair_scores as ps

    rng = random.Random(8)
    scored, lcs = [], ps.lcs

    def counted(a, b, ai, bi, *pieces):
        scored.append(len(ai))
        return lcs(a, b, ai, bi, *pieces)

    monkeypatch.setattr(ps, "lcs", counted)
    for longest in (12, 30, 70, 140):
        a = ps.Texts([""] + ["".join(rng.choices("abcdé ", k=rng.randint(1, longest))) for _ in range(24)])
        b = ps.Texts(["", *a.texts[3:6]] + ["".join(rng.choices("abcdü ", k=rng.randint(1, longest + 8))) for _ in range(24)])
        table = ps.lcs_table(a, slice(2, 25), b)
        assert table.tolist() == [[scorers.lcs_length(x, y) for y in b.texts] for x in a.texts[2:]]
        for floor in (0, 60, 80, 100):
            scored.clear()
            got = {(i, j): s for part in ps.scored_block("partial_ratio", a, b, floor) for i, j, s in zip(*(p.tolist() for p in part))}
            plain = {(i, j): scorers.partial_ratio(x, y) for i, x in enumerate(a.texts) for j, y in enumerate(b.texts)}
            assert got == pytest.approx({k: s for k, s in plain.items() if s >= floor and s > 0})
        # most windows cannot reach the floor, as what comes before their end and after their start tells
        scored.clear()
        list(ps.scored_block("partial_ratio", a, b, 60))
        windows = sum(len(x) + len(y) for x in a.texts for y in b.texts if x and y)
        assert sum(scored) <= windows / 4
