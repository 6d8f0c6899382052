"""Composite dataflows on hand-made people and companies."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fitlens.operators import joins as j
from fitlens.operators import ranking as rk
from fitlens.plans import alignment as al
from fitlens.plans import companies as co
from fitlens.plans import profiles as pf
from fitlens.plans.training import training_rows
from fitlens.sources.io import dealt

PROFILES = """id string, name string, educations_details string, education array<struct<degree:string>>,
experience array<struct<subtitle:string,duration_short:string>>, volunteer_experience array<struct<cause:string>>,
`current_company:name` string"""


@pytest.fixture
def people(frame):
    data = [
        ("1", "N", "Brown University", [("PhD",), ("M.S.",)], [("B", "2 years"), ("A", "1 year"), (None, None)], [("Education",)], "A"),
        ("2", "N", None, [("Diploma",)], [("A", "5 months")], [], None),
        ("3", "M", "Brownstone", [], [], None, "C"),
        ("4", "O", "x", None, None, [("Education",), ("Health",), ("Education",), ("Foo",), (None,)], "A"),
        ("5", "P", "x", [("BSc",)], [("B", ""), ("B", "")], None, "B"),
    ]
    return pf.flatten_profiles(frame(data, PROFILES))


@pytest.fixture
def companies(frame):
    data = [("A", "Nonprofit"), ("B", "Self-Employed"), ("C", None), ("D", "Public"), ("E", "Public"), ("E", "Public")]
    return frame(data, "name string, organization_type string")


def test_employment(people):
    expected = [("A", "1"), ("A", "2"), ("A", "4"), ("B", "1"), ("B", "5"), ("C", "3")]
    assert rows(pf.employment(people)) == expected
    now = people.people.select(F.col("current_company").alias("company_name"), "id")
    other = j.bridge_full_outer(now, people.employers.select("company_name", "id"))
    assert rows(other.select("company_name", "id")) == expected


def test_eligible_companies(people, companies):
    assert rows(co.eligible_companies(pf.employment(people), companies, 2)) == [("A", 3), ("B", 2)]
    doubled = companies.union(companies.filter("name = 'A'"))
    assert rows(co.eligible_companies(pf.employment(people), doubled, 2)) == [("B", 2)]


def test_degrees(people):
    assert dict(pf.degrees(people).collect()) == {"1": ["Doctorate", "Master"], "2": [], "3": [], "4": [], "5": ["Bachelor"]}
    shared = dict(pf.degrees(people, by="name").collect())
    assert shared["1"] == shared["2"] == ["Doctorate", "Master"]
    assert sorted(r["id"] for r in pf.degrees(people, drop_without_education=True).collect()) == ["1", "2", "5"]


def test_engineer(people):
    got = {r["id"]: r for r in pf.engineer(people).collect()}
    assert [got[i]["top_university"] for i in "12345"] == [1, 0, 0, 0, 0]
    assert [got[i]["volunteering"] for i in "12345"] == [1, 0, 0, 1, 0]
    assert [got[i]["average_months_of_experience"] for i in "12345"] == [18.0, 5.0, None, None, 0.0]
    assert got["3"]["degrees"] == [] and got["3"]["has_master"] == 0


def test_volunteer_values(people):
    got = rows(pf.volunteer_values(people.causes).filter("id = '4'").select("value", "detail"))
    assert got == [
        ("Altruism", "Education"), ("Community", None), ("Contribution", None), ("Empathy", "Health"), ("Meaningful work", None),
    ]
    view = dict(pf.values_map(pf.volunteer_values(people.causes)).collect())
    assert view["4"]["Empathy"] == [["volunteering", "Health"]] and view["4"]["Community"] == [["volunteering", None]]
    assert "2" not in view


def test_feature_values(people, companies):
    bridge = pf.employment(people)
    flags = pf.org_type_flags(pf.org_types_per_profile(bridge, companies))
    got = rows(pf.feature_values(pf.engineer(people), flags))
    mine = [(f, v) for i, f, v in got if i == "1"]
    assert [v for f, v in mine if f == "organization_types"] == ["Community", "Contribution", "Meaningful work"]
    assert [v for f, v in mine if f == "degrees"] == ["Autonomy", "Excellence", "Learning"]
    assert [v for f, v in mine if f == "top_university"] == ["Excellence", "Learning"]
    assert [(f, v) for i, f, v in got if i == "5"] == [("organization_types", "Accountability"), ("organization_types", "Autonomy")]
    nested = {r["id"]: r["values_from_features"] for r in pf.feature_values_struct(pf.engineer(people), flags).collect()}
    assert nested["3"].top_university is None and nested["5"].company_and_organization_types == ["Accountability", "Autonomy"]


def test_patterns(people, companies):
    bridge = pf.employment(people)
    chosen = co.eligible_companies(bridge, companies, 1)
    got = {r["company_name"]: r for r in co.patterns(co.staff(bridge, chosen, pf.engineer(people))).collect()}
    assert got["A"]["volunteering_percentage"] == pytest.approx(200 / 3)
    assert got["A"]["mean_post_duration"] == 11.5 and got["A"]["variance_post_duration"] == pytest.approx(84.5)
    assert got["A"]["degree_percentage"] == "Bachelor: 0.0 %, Associate: 0.0 %, Master: 50.0 %, No Degree: 100.0 %"
    assert got["C"]["master_percentage"] is None and got["C"]["degree_percentage"].startswith("Bachelor:  %")
    assert got["C"]["variance_post_duration"] is None


def test_population(people, companies):
    bridge = pf.employment(people)
    chosen = co.eligible_companies(bridge, companies, 1)
    once = rows(co.population(bridge, chosen, pf.engineer(people)).select("company_name", "id", "doctorate", "master"))
    assert once == [("A", "1", 1, 0), ("A", "2", 0, 0), ("A", "4", 0, 0), ("B", "5", 0, 0), ("C", "3", 0, 0)]
    every = co.population(bridge, chosen, pf.engineer(people), "all")
    assert every.count() == 6 and every.agg(F.sum("master")).first()[0] == 2


def test_ztests(frame):
    data = [("A", int(i < 20)) for i in range(50)] + [("B", int(i < 10)) for i in range(50)]
    got = {r["company_name"]: r for r in co.ztests(frame(data, "company_name string, f int"), ["f"]).collect()}
    assert got["A"]["z"] == pytest.approx(1.224745, abs=1e-6) and got["A"]["p_value"] == pytest.approx(0.2207, abs=1e-4)
    below = (0.2 - 0.3) / math.sqrt((40 / 150) * (110 / 150) * (1 / 50 + 1 / 100))
    assert got["B"]["z"] == pytest.approx(below) and got["B"]["direction"] == -1
    none = co.ztests(frame([("A", 0), ("B", 0)], "company_name string, f int"), ["f"])
    assert all(r["p_value"] is None for r in none.collect())


def test_welch(frame):
    data = [("A", 1.0), ("A", 2.0), ("A", 4.0), ("B", 8.0), ("B", 9.0), ("B", None), ("C", None), ("D", 3.0)]
    got = {r["company_name"]: r for r in co.welch_tests(frame(data, "company_name string, x double"), "x").collect()}
    a, everybody = [1.0, 2.0, 4.0], [1.0, 2.0, 4.0, 8.0, 9.0, 3.0]

    def var(v):
        return sum((x - sum(v) / len(v)) ** 2 for x in v) / (len(v) - 1)

    t = (sum(a) / 3 - sum(everybody) / 6) / math.sqrt(var(a) / 3 + var(everybody) / 6)
    assert got["A"]["t"] == pytest.approx(t) and got["A"]["var2"] == pytest.approx(var(everybody))
    assert 0 < got["A"]["p_value"] < 1 and "C" not in got and got["D"]["p_value"] is None


def test_company_values_and_summary(frame, spark):
    from fitlens.sources.io import dealt, lexicon_df

    texts = frame([("X", "hot stuff", None, "cold"), ("Y", None, "hot hot", None)], "company_name string, scraped_data string, about string, slogan string")
    lexicon = lexicon_df(spark, {"Heat": ["hot"], "Chill": ["cold"]})
    values = co.company_values(texts, lexicon)
    assert rows(values) == [("X", "Chill", "slogan"), ("X", "Heat", None), ("Y", "Heat", None)]
    ranked = frame([("X", "master", 0.01, 1)], "company_name string, feature string, p_value double, rank int")
    themes = frame([("X", 0, "[1, 2]"), ("X", 1, "[3, 4]")], "company_name string, cluster int, colour string")
    emotions = frame([("X", "happy"), ("Y", None)], "company_name string, company_emotion string")
    got = rows(co.company_summary(ranked, values, themes, emotions).filter("company_name = 'X'").select("section", "rank", "item"))
    assert got == [
        ("feature", 1, "master"), ("picture", None, "happy"), ("theme", 1, "[1, 2]"), ("theme", 2, "[3, 4]"),
        ("value_slogan", None, "Chill"), ("value_text", None, "Heat"),
    ]


def test_match_values(frame):
    pairs = frame([("p", "c")], "id string, company_name string")
    mine = frame([("p", "A", None), ("p", "B", "volunteering")], "id string, value string, source string")
    theirs = frame([("c", "A", "slogan"), ("c", "A", None), ("c", "B", None)], "company_name string, value string, source string")
    got = rows(al.match_values_pair(pairs, mine, theirs).select("value", "profile_source", "company_source"))
    assert got == [("A", None, "slogan"), ("B", "volunteering", None)]
    both = mine.union(frame([("p", "A", "volunteering")], "id string, value string, source string"))
    got = rows(al.match_values_pair(pairs, both, theirs).select("value", "profile_source", "company_source"))
    assert got[0] == ("A", "volunteering", "slogan")
    # one known source on each side: the slogan comes first
    tie = al.match_values_pair(
        pairs,
        both,
        frame([("c", "A", None), ("c", "A", "slogan")], "company_name string, value string, source string"),
    )
    assert tie.count() == 1


def test_profile_values(frame):
    features = frame([("p", "top_university", "Excellence"), ("p", "degrees", "Excellence")], "id string, feature string, value string")
    volunteer = frame([("p", "Community", "volunteering", None), ("p", "Excellence", "volunteering", None)], "id string, value string, source string, detail string")
    got = rows(al.profile_values(features, volunteer, None))
    assert got == [("p", "Community", "volunteering"), ("p", "Excellence", "top_university"), ("p", "Excellence", None)]
    text = frame([("p", "Growth")], "id string, value string")
    assert ("p", "Growth", None) in rows(al.profile_values(features, volunteer, None, text))


def test_match_patterns(frame, people):
    pairs = frame([("1", "A"), ("5", "A"), ("4", "A")], "id string, company_name string")
    ranked = frame(
        [("A", "master", 0.01), ("A", "doctorate", 0.02), ("A", "volunteering", 0.03), ("A", "average_tenure", 0.001)],
        "company_name string, feature string, p_value double",
    )
    traits = al.profile_traits(pf.engineer(people))
    got = rows(al.match_patterns(pairs, traits, ranked).select("id", "feature"))
    assert got == [("1", "doctorate"), ("1", "volunteering"), ("4", "volunteering")]
    strict = al.match_patterns(pairs, al.profile_traits(pf.engineer(people), strict=True), ranked)
    assert rows(strict.select("id", "feature")) == [("1", "doctorate")]
    only_master = ranked.filter("feature = 'master'")
    assert rows(al.match_patterns(pairs, traits, only_master).select("id", "feature")) == [("1", "master")]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_matches_need_no_ranking_and_pairs_are_dealt(frame):
    """Values and traits are matched without sorting the pairs, and pairs get a task for each so many rows."""
    pairs = frame([(str(i), c) for i in range(30) for c in "AB"] + [("0", "A")], "id string, company_name string")
    mine = frame([(str(i), v, s) for i in range(30) for v in "xy" for s in (None, "volunteering") if i % 3 or s is None], "id string, value string, source string")
    theirs = frame([("A", "x", None), ("A", "x", "slogan"), ("B", "x", None), ("B", "z", "slogan")], "company_name string, value string, source string")
    got = al.match_values_pair(pairs, mine, theirs)
    assert "Window" not in plan_of(got)
    source = lambda i: "volunteering" if i % 3 else None
    assert rows(got) == sorted(((str(i), c, "x", source(i), {"A": "slogan", "B": None}[c]) for i in range(30) for c in "AB"), key=repr)
    traits = frame([("1", "master", None), ("1", "doctorate", None), ("2", "master", "m")], "id string, feature string, detail string")
    tests = frame([("A", "master", 0.1), ("A", "doctorate", 0.2), ("B", "master", 0.3)], "company_name string, feature string, p_value double")
    found = al.match_patterns(pairs, traits, tests)
    assert "LeftAnti" not in plan_of(found)
    assert rows(found.drop("p_value")) == [("1", "A", "doctorate", None), ("1", "B", "master", None), ("2", "A", "master", "m"), ("2", "B", "master", "m")]
    assert dealt(pairs, "id", 5).rdd.getNumPartitions() == 13 and rows(dealt(pairs, "id", 5)) == rows(pairs)


def test_negatives_are_drawn_once(people, companies):
    engineered, bridge = pf.engineer(people), pf.employment(people)
    out = training_rows(co.population(bridge, co.eligible_companies(bridge, companies, 1), engineered), pf.org_types_per_profile(bridge, companies), 3)
    assert "md5" not in plan_of(out)


def test_match_label(frame):
    pairs = frame([("1", "A"), ("1", "B"), ("2", "A")], "id string, company_name string")
    mine = frame([("1", "happy"), ("2", None)], "id string, emotion string")
    theirs = frame([("A", "happy"), ("B", "neutral")], "company_name string, company_emotion string")
    got = rows(al.match_label(pairs, mine, theirs).select("company_name", "agree"))
    assert got == [("A", 1), ("B", 0)]


def test_advice(frame):
    values = frame(
        [("p", "c", v, s, t) for v, s, t in [("E", None, None), ("D", "volunteering", "slogan"), ("C", None, "slogan"), ("B", "volunteering", None), ("A", None, None)]],
        "id string, company_name string, value string, profile_source string, company_source string",
    )
    traits = frame([("p", "c", "doctorate", None, 0.02), ("p", "c", "top_university", "Brown", 0.01)], "id string, company_name string, feature string, detail string, p_value double")
    themes = frame([("p", "c", "[1, 2] and [3, 4]")], "id string, company_name string, colors string")
    labels = frame([("p", "c", "happy", "neutral", 0)], "id string, company_name string, emotion string, company_emotion string, agree int")
    got = al.advice(values, traits, 3, labels, themes)
    listed = got.orderBy("section", "rank").collect()
    assert [(r["section"], r["item"]) for r in listed] == [
        ("patterns", "top_university"), ("patterns", "doctorate"), ("picture", "happy"), ("theme", "[1, 2] and [3, 4]"),
        ("values", "D"), ("values", "B"), ("values", "C"),
    ]
    assert [r["book"] for r in listed if r["section"] == "values"] == ["value_both", "value_profile", "value_company"]
    assert all("{" not in r["sentence"] and "c" in r["sentence"] for r in listed)
    assert "Brown" in listed[0]["sentence"] and "neutral" in listed[2]["sentence"]
    assert rows(got) == rows(al.advice(values.repartition(3), traits, 3, labels, themes))


def test_align_end_to_end(frame, people, companies):
    bridge, engineered = pf.employment(people), pf.engineer(people)
    features = pf.feature_values(engineered, pf.org_type_flags(pf.org_types_per_profile(bridge, companies)))
    mine = al.profile_values(features, pf.volunteer_values(people.causes), engineered)
    theirs = frame([("A", "Altruism", "slogan"), ("A", "Autonomy", None)], "company_name string, value string, source string")
    tests = co.all_tests(co.population(bridge, co.eligible_companies(bridge, companies, 1), engineered))
    ranked = rk.rank_features(tests, 1.1)
    themes = frame([("A", 0, "[1]"), ("A", 1, "[2]")], "company_name string, cluster int, colour string")
    pairs = frame([("1", "A"), ("4", "A"), ("3", "C")], "id string, company_name string")
    got = al.align(pairs, mine, theirs, al.profile_traits(engineered), ranked, 1, themes=themes)
    listed = {(r["id"], r["section"], r["item"]) for r in got.collect()}
    assert ("1", "values", "Altruism") in listed and ("1", "values", "Autonomy") in listed
    assert ("4", "values", "Altruism") in listed and ("4", "values", "Autonomy") not in listed
    assert ("1", "theme", "[1] and [2]") in listed and not any(i == "3" for i, s, _ in listed if s == "values")
    summary = rows(al.profile_summary(engineered, people.causes, mine).filter("id = '4'").select("section", "item", "source"))
    assert ("volunteer", "Health", None) in summary and ("value_sourced", "Empathy", "volunteering") in summary
    assert not any(s == "average_tenure" for s, _, _ in summary)


def test_company_emotion(frame):
    scores = frame([("A", 0.9, None), ("A", 0.1, 0.4), ("B", 0.5, None)], "company_name string, happy_score double, neutral_score double")
    assert rows(co.company_emotion(scores)) == [("A", 0.5, 0.4, "happy"), ("B", 0.5, None, None)]


def test_training_rows(people, companies):
    bridge = pf.employment(people)
    population = co.population(bridge, co.eligible_companies(bridge, companies, 1), pf.engineer(people))
    got = training_rows(population, pf.org_types_per_profile(bridge, companies), 1).collect()
    assert sum(r["label"] for r in got) == 5 and sum(1 - r["label"] for r in got) == 2 + 1 + 1
    texts = {r["id"]: r["organization_types"] for r in got}
    assert texts["1"] == "Nonprofit Self-Employed " and texts["3"] == ""
    assert {r["average_months_of_experience"] for r in got if r["id"] == "3"} == {-1.0}


def test_pooled_variance_of_large_values(frame):
    data = [("A", 1e8 + x) for x in (0.0, 1.0, 2.0)] + [("B", 1e8 + x) for x in (0.5, 1.5, 2.5)]
    sums = co.company_sums(frame(data, "company_name string, x double"), [], "x")
    everybody = sums.select("everybody.*").first()
    assert abs(everybody["var2"] - 0.875) < 1e-6 and everybody["mean2"] == 1e8 + 1.25


def test_nested_rows_against_long_tables(frame):
    """Features of nested rows are those of the long tables, without a shuffle."""
    schema = """id string, name string, educations_details string, `current_company:name` string, education array<struct<degree:string>>,
    experience array<struct<duration_short:string,subtitle:string>>, volunteer_experience array<struct<cause:string>>"""
    data = [
        ("a", "A", "Brown University", "X", [("BSc",), ("PhD in x",), None], [("2 years", "X"), ("6 months", None), (None, "Y")], [("Education",), ("Education",), ("Chess",)]),
        ("b", "B", None, None, None, None, None),
        ("c", "C", "", "Y", [], [], []),
        ("d", "D", "", "Y", [(None,)], [("no time", "Z"), None], [(None,)]),
    ]
    nested = frame(data, schema)
    got = pf.engineer_rows(nested)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("Scan") == 1
    p = pf.flatten_profiles(nested.filter("id <> 'd'"))
    want = {r["id"]: r.asDict() for r in pf.engineer(p).collect()}
    maps = dict(pf.values_map(pf.volunteer_values(p.causes)).collect())
    for r in got.collect():
        if r["id"] == "d":
            assert (r["volunteering"], r["average_months_of_experience"], r["causes"], r["degrees"]) == (1, 0.0, [], [])
            continue
        w = want[r["id"]]
        same = ["top_university", "volunteering", "average_months_of_experience", "degrees", "has_bachelor", "has_doctorate", "has_master", "has_associate"]
        assert {c: r[c] for c in same} == {c: w[c] for c in same}, r["id"]
        assert r["values_from_volunteering"] == maps.get(r["id"], {})
    assert rows(pf.employment(p)) == [("X", "a"), ("Y", "a"), ("Y", "c")]
