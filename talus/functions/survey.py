"""Rules that turn coded survey answers into profile values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from talus.functions.text import collapse

# Columns of the survey, age bands, and targets of the crosswalk; None leaves an answer unsupported on purpose.
SURVEY_COLUMNS = (
    "age", "sex", "race", "hispanic", "region", "born", "marital", "childs", "degree", "educ", "wrkstat", "class", "polviews", "relig", "reliten",
    "health", "trust", "fefam"
)
AGE_BANDS = ((18, 24), (25, 34), (35, 44), (45, 54), (55, 64), (65, 74), (75, 84))
VALUE_MAPS: dict[str, tuple[str, dict[str, str | None]]] = {
    "gender_identity": ("sex", {"female": "Woman", "male": "Man"}),
    "demo_citizenship_status": ("born", {"yes": "Citizen by birth", "no": None}),
    "demo_children_count": ("childs", {
        "0": "None", "0.0": "None", "1": "1 child", "1.0": "1 child", "2": "2 children", "2.0": "2 children",
        "3": "3+ children", "3.0": "3+ children", "4": "3+ children", "4.0": "3+ children", "5": "3+ children", "5.0": "3+ children",
        "6": "3+ children", "6.0": "3+ children", "7": "3+ children", "7.0": "3+ children", "8 or more": "3+ children",
    }),
    "demo_marital_status": (
        "marital", {"married": "Married", "never married": "Single", "divorced": "Divorced", "widowed": "Widowed", "separated": "Separated"}
    ),
    "socioeconomic_band": (
        "class",
        {"lower class": "Low income", "working class": "Lower-middle", "middle class": "Middle", "upper class": "Upper-middle", "no class": None}
    ),
    "demo_employment_status": ("wrkstat", {
        "working full time": "Full-time", "working part time": "Part-time", "retired": "Retired", "keeping house": "Homemaker",
        "unemployed, laid off, looking for work": "Unemployed", "in school": "Student",
        "with a job, but not at work because of temporary illness, vacation, strike": "Full-time", "other": None,
    }),
    "political_lean": ("polviews", {
        "extremely liberal": "Left", "liberal": "Left", "slightly liberal": "Center-left", "moderate, middle of the road": "Center",
        "slightly conservative": "Center-right", "conservative": "Right", "extremely conservative": "Right",
    }),
    "demo_religion_affiliation": ("relig", {
        "protestant": "Christian", "catholic": "Christian", "christian": "Christian", "orthodox-christian": "Christian", "jewish": "Jewish",
        "muslim/islam": "Muslim", "buddhism": "Buddhist", "hinduism": "Hindu", "none": "None", "native american": "Folk / traditional",
        "other": None, "inter-nondenominational": None, "other eastern religions": None,
    }),
    "health_general_health": ("health", {"excellent": "Excellent", "good": "Good", "fair": "Fair", "poor": "Poor"}),
    "trust_level": ("trust", {"most people can be trusted": "Trusting", "can't be too careful": "Skeptical", "depends": "Verifying"}),
    "att_traditional_gender_roles": ("fefam", {"strongly agree": "Enthusiast", "agree": "Positive", "disagree": "Skeptical", "strongly disagree": "Opposed"}),
}


def answer_key(x: Column) -> Column:
    """Form in which answers are looked up: whole numbers as '1.0', straight apostrophes, lower case, single spaces; null stays null."""
    text = F.translate(F.lower(collapse(x)), "’‘", "''")
    number = x.cast("string").try_cast("double")
    whole = F.typeof(x).isin("tinyint", "smallint", "int", "bigint", "float", "double") & (F.abs(number) < 1e15) & (number == F.floor(number))
    return F.when(x.isNotNull(), F.when(whole, F.format_string("%.1f", number)).otherwise(text))


def age_bracket(age: Column) -> Column:
    """Bands with whole bounds; ages between two bands have none."""
    n = age.cast("string").try_cast("double")
    out = F.when(F.contains(F.lower(age.cast("string")), F.lit("older")), "85+")
    for low, high in AGE_BANDS:
        out = out.when(n.between(low, high), f"{low}-{high}")
    return out.when((n >= 85) & ~F.isnan(n), "85+")


def ethnicity(hispanic: Column, race: Column, key: Callable[[Column], Column] = answer_key) -> Column:
    h, r = key(hispanic), key(race)
    return F.when((h != "") & (h != "not hispanic"), "Hispanic / Latino").when(r == "white", "White / European").when(r == "black", "Black / African")


def education(degree: Column, educ: Column, key: Callable[[Column], Column] = answer_key) -> Column:
    d, e = key(degree), F.coalesce(key(educ), F.lit(""))
    years = F.regexp_extract(e, r"^(\d+)", 1).try_cast("int")
    return (
        F.when(d == "graduate", F.when(e.contains("7 years") | e.contains("8 or more years"), "Doctorate").otherwise("Master's"))
        .when(d == "bachelor's", "Bachelor's").when(d == "associate/junior college", "Associate's").when(d == "high school", "Secondary")
        .when(d == "less than high school", F.when(years <= 8, "Primary").otherwise("Secondary"))
    )


def religiosity(relig: Column, intensity: Column, key: Callable[[Column], Column] = answer_key) -> Column:
    r, i = key(relig), key(intensity)
    return F.when((r == "none") | (i == "no religion"), "Secular").when(i == "strong", "Devout").when(i == "somewhat strong (vol.)", "Observant").when(i == "not very strong", "Spiritual")


# Answers that the computed targets look up by their keys.
COMPUTED_FROM = ("hispanic", "race", "degree", "educ", "wrkstat", "relig", "reliten", "region")


def computed(keyed: Callable[[str], Column] | None = None) -> dict[str, Column]:
    """Targets that rules compute from several answers. keyed: where an answer's key is found; else it is made of the answer, wherever it is used."""
    same = lambda x: x
    k, key = (keyed, same) if keyed else (F.col, answer_key)
    c, work = F.col, key(k("wrkstat"))
    return {
        "age_bracket": age_bracket(c("age")),
        "demo_ethnicity_broad": ethnicity(k("hispanic"), k("race"), key),
        "highest_education": education(k("degree"), k("educ"), key),
        "seniority": F.when(work == "retired", "Retired").when(work == "in school", "Student / intern"),
        "life_stage": F.when(work == "in school", "Student").when(work == "retired", "Retirement"),
        "religiosity": religiosity(k("relig"), k("reliten"), key),
        "region": F.when(key(k("region")) != "", "North America"),
    }
