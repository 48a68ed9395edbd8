import random

from tallyframe.operators import count_levels, group_counts, listed_subset, long_counts

ROWS = [
    {"p918": "1", "p3000": "AK"},
    {"p918": "1", "p3000": "AK"},
    {"p918": "2", "p3000": "AL"},
    {"p918": "1", "p3000": "LONG"},
    {"p918": "1"},
    {"p918": "1", "p3000": ""},
]


def levels(frame, name="n"):
    return {r["subset"] if not r["national"] else "ALL": r[name] for r in frame.collect()}


def test_two_national_totals(make_input):
    data = make_input(ROWS)
    listed = levels(count_levels(data, {"n": "p918 = 1"}, listed_subset(), total="listed"))
    assert listed == {"AK": 2, "AL": 0, "": 1, "ALL": 3}
    assert levels(count_levels(data, {"n": "p918 = 1"}, listed_subset(), total="all"))["ALL"] == 5


def test_static_list_is_zero_filled(make_input):
    codes = ["AK", "WY"]
    out = count_levels(make_input(ROWS), {"n": "p918 = 1"}, listed_subset(codes=codes), codes, "listed")
    assert levels(out) == {"AK": 2, "WY": 0, "ALL": 2}


def test_empty_input(make_input):
    out = count_levels(make_input([]), {"n": "p918 = 1"}, listed_subset(codes=["AK"]), ["AK"])
    assert levels(out) == {"AK": 0, "ALL": 0}


def test_any_name_is_a_column(make_input):
    out = count_levels(make_input(ROWS), {"null": "p918 = 1", "a`b": "p918 = 2"}, listed_subset())
    assert levels(out, "null")["AK"] == 2 and levels(out, "a`b")["AL"] == 1
    assert long_counts(out, ["null", "a`b"]).where("cell = 'null' AND subset = 'AK'").first()["n"] == 2


def test_fused_equals_one_query_per_condition(make_input):
    rng = random.Random(7)
    rows = [
        {
            "p918": rng.choice(["1", "2", None]),
            "p301": rng.choice(["0", "1", "2", "x"]),
            "p901": rng.choice(["20200101", "20210101", None]),
            "p3000": rng.choice(["AK", "AL", "AZ", "LONG", None]),
        }
        for _ in range(400)
    ]
    atoms = ["p918 = 1", "p301 > 0", "p901 IS NULL", "p901 >= DATE '2020-06-01'", "p301 IN (1, 2)"]
    texts = {
        f"c{i}": f" {rng.choice(['AND', 'OR'])} ".join(rng.sample(atoms, rng.randint(1, 3)))
        for i in range(10)
    }
    data = make_input(rows).cache()
    fused = count_levels(data, texts, listed_subset())
    wide = {("ALL" if r["national"] else r["subset"]): r for r in fused.collect()}
    for name, text in texts.items():
        single = data.where(text)
        assert wide["ALL"][name] == single.count()
        for code in ("AK", "AL", "AZ"):
            assert wide[code][name] == single.where(f"p3000 = '{code}'").count()
    data.unpersist()


def test_dirty_codes_share_one_group(make_input):
    rows = [{"p918": "1", "p3000": f"DIRTY{i}"} for i in range(50)] + [{"p918": "1", "p3000": "AK"}]
    assert group_counts(make_input(rows), {"n": "p918 = 1"}, listed_subset()).count() == 2
