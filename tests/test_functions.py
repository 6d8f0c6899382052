"""Column functions on hand-made rows, with NULLs, empty arrays and ties."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fitlens.functions import arrays as fa
from fitlens.functions import stats as st
from fitlens.functions import text as ft


def values(frame, items, kind, fn):
    df = frame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_degree_level(frame):
    texts = ["Bachelor and Master", "Ph.D", "M.S.", "assoc.", "Diploma", None, "M.B.A.", "postmaster", "Licence"]
    expected = ["Bachelor", "Doctorate", "Master", "Associate", None, None, "Bachelor", "Master", "Bachelor"]
    assert values(frame, texts, "string", ft.degree_level) == expected


def test_duration_months(frame):
    texts = ["2 years 3 months", "1 year", "11 months", "less than a year", " 2 years", " 3 months", "", "10years4months", None]
    assert values(frame, texts, "string", ft.duration_months) == [27, 12, 11, 0, 0, 3, 0, 124, None]
    strict = values(frame, texts, "string", lambda c: ft.duration_months(c, "null"))
    assert strict == [27, 12, 11, None, None, 3, None, 124, None]


def test_any_name(frame):
    texts = ["Brown University", "Brownstone", "Maurice", None, "RICE, Houston"]
    assert values(frame, texts, "string", lambda c: ft.any_name(c, ["brown", "rice"])) == [1, 0, 0, 0, 1]
    odd = values(frame, ["a.b c", "axb"], "string", lambda c: ft.any_name(c, ["a.b"]))
    assert odd == [1, 0]


def test_degree_code(frame):
    names = [None, "Bachelor", "Master", "Doctorate", "Associate"]
    assert values(frame, names, "string", ft.degree_code) == [0, 1, 2, 3, 4]


def test_spaced_text(frame):
    lists = [["Nonprofit", None, "Public"], None, []]
    assert values(frame, lists, "array<string>", ft.spaced_text) == ["Nonprofit Public ", "", ""]


def test_dominant_label(frame):
    df = frame([(0, 0.9, 0.1), (1, 0.1, 0.9), (2, 0.5, 0.5), (3, None, 0.5)], "i int, h double, n double")
    got = [r[0] for r in df.orderBy("i").select(ft.dominant_label(F.col("h"), F.col("n"))).collect()]
    assert got == ["happy", "neutral", "neutral", None]


def test_stored_score(frame):
    texts = ["[{score=0.91, label=happy1}, {score=0.05, label=neutral1}]", "0", None]
    got = values(frame, texts, "string", lambda c: ft.stored_score(c, "neutral1"))
    assert got[0] == pytest.approx(0.05) and got[1:] == [None, None]


def test_percent_text(frame):
    df = frame([(0, 1, 3), (1, 2, 0)], "i int, x long, n long")
    got = [r[0] for r in df.orderBy("i").select(ft.percent_text({"A": F.col("x")}, F.col("n"))).collect()]
    assert got == ["A: 33.33 %", "A:  %"]


def test_template_and_colon(frame):
    df = frame([("Power: resources", None)], "s string, n string")
    filled = ft.fill_template(F.lit("{a}-{b}-{a}"), {"a": F.col("s"), "b": F.col("n")})
    row = df.select(filled, ft.before_colon(F.col("s")), ft.after_colon(F.col("s"))).first()
    assert tuple(row) == ("Power: resources--Power: resources", "Power", " resources")


def test_arrays(frame):
    assert values(frame, [None, [], ["a"]], "array<string>", fa.has_items) == [0, 0, 1]
    df = frame([(None, ["a"]), (["a", None, "a"], [None, "b"])], "a array<string>, b array<string>")
    got = df.select(fa.merged([F.col("a"), F.col("b")]), F.array_union("a", "b")).collect()
    assert got[0][0] == ["a"] and got[1][1] == ["a", None, "b"]
    assert values(frame, [[1.0, 0.0], [0.0, 0.0]], "array<double>", lambda c: fa.cosine(c, F.array(F.lit(1.0), F.lit(1.0)))) == [
        pytest.approx(1 / math.sqrt(2)),
        None,
    ]


def test_two_proportions(frame):
    df = frame([(20, 50, 30, 100), (30, 100, 20, 50), (0, 50, 0, 100), (50, 50, 9, 9)], "a long, b long, c long, d long")
    z = st.two_proportion_z(*[F.col(c) for c in "abcd"])
    got = df.select(z.alias("z"), st.normal_two_sided(z).alias("p")).collect()
    assert got[0].z == pytest.approx(1.224745, abs=1e-6) and got[0].p == pytest.approx(0.2207, abs=1e-4)
    assert got[1].z == pytest.approx(-got[0].z) and got[1].p == pytest.approx(got[0].p)
    assert got[2].z is None and got[2].p is None and got[3].z is None


def test_erfc(frame):
    points = [0.0, 1e-9, 0.1, 0.5, 1.0, 1.9, 2.0, 2.1, 3.0, 4.0, 8.0, 20.0]
    assert values(frame, points, "double", st.erfc) == [pytest.approx(math.erfc(x), rel=1e-11) for x in points]
    assert values(frame, [None], "double", st.erfc) == [None]


def test_logarithms_of_normal_tails(frame):
    """Far out p is zero in doubles; the logarithm follows the asymptotic series."""
    points = [60.0, 80.0, -80.0, 1000.0, 1e6]
    series = lambda z: math.log(2 / math.sqrt(2 * math.pi) / z) - z * z / 2 + math.log(1 - z**-2 + 3 * z**-4 - 15 * z**-6)
    assert values(frame, points, "double", st.log_normal_two_sided) == [pytest.approx(series(abs(z)), rel=1e-12) for z in points]
    near = [0.0, 0.3, 2.0, 2.9, 6.0]
    assert values(frame, near, "double", st.log_normal_two_sided) == [pytest.approx(math.log(math.erfc(z / math.sqrt(2))), rel=1e-10, abs=1e-15) for z in near]


def test_logarithms_of_student_tails():
    # For even degrees of freedom there is a closed form; for two of them p = 1 - t / sqrt(2 + t^2).
    t = np.array([1.0, 50.0, 1e5])
    exact = [math.log(2 / ((2 + x * x) * (1 + x / math.sqrt(2 + x * x)))) for x in t]
    assert st.log_student_two_sided_array(t, np.full(3, 2.0)) == pytest.approx(exact, rel=1e-10)
    # With very many it comes near to the normal distribution, and it falls with t where p itself is zero.
    normal = lambda z: math.log(2 / math.sqrt(2 * math.pi) / z) - z * z / 2 + math.log(1 - z**-2 + 3 * z**-4)
    assert st.log_student_two_sided_array([20.0], [1e9])[0] == pytest.approx(normal(20.0), rel=1e-4)
    far = st.log_student_two_sided_array([60.0, 80.0, 100.0], [1e6] * 3)
    assert far[0] > far[1] > far[2] > -1e5 and st.student_two_sided_array([80.0], [1e6])[0] == 0.0


def test_student(frame):
    df = frame([(2.228, 10.0), (-3.169, 10.0), (2.776, 4.0), (1.96, 1e7), (0.0, 5.0), (None, 5.0)], "t double, df double")
    got = [r[0] for r in df.select(st.student_two_sided("t", "df")).collect()]
    assert got[:5] == [pytest.approx(p, abs=1e-4) for p in (0.05, 0.01, 0.05, 0.05, 1.0)]
    assert got[5] is None
    # df = 1 is the Cauchy distribution, df = 2 has a closed form
    t = np.array([0.01, 0.5, 3.0, 100.0])
    assert st.student_two_sided_array(t, np.ones(4)) == pytest.approx(1 - 2 / np.pi * np.arctan(t), rel=1e-10)
    assert st.student_two_sided_array(t, np.full(4, 2.0)) == pytest.approx(1 - t / np.sqrt(2 + t * t), rel=1e-9)
