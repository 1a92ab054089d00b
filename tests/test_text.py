"""Text columns against brute force in Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from moodtide.functions import dates, numbers, text as T

# The patterns whose matches must be equal.
PYTHON_PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    "url": re.compile(r"(?:https?://|www\.)\S+", re.I),
    "handle": re.compile(r"(?<![\w/])/?u/[A-Za-z0-9_-]+", re.I),
    "mention": re.compile(r"(?<!\w)@[A-Za-z0-9_]{2,}"),
    "phone": re.compile(r"(?<!\w)\+?\d[\d\s().-]{5,}\d(?!\w)"),
}

LEAKS = [
    ("my address: o.lund-9@post.site.example, any time", "o.lund"),
    ("(http://notes.example/~ola?x=1)", "notes.example"),
    ("it was on www.walks.example/north yesterday", "walks"),
    ("u/quiet_reader said so", "quiet_reader"),
    ("credit: /u/Night-Owl.", "Night-Owl"),
    ("is @kim_w42 around?", "@kim_w42"),
    ("ring +47 (22) 85-50.50 after six", "85-50"),
    ("22 85 50 50 is the number", "85 50"),
    ("HTTP://NOTES.EXAMPLE/OLA", "NOTES"),
    ("as U/Quiet_Reader said", "Quiet_Reader"),
]
HARMLESS = "Ran 4 miles on day 12, then slept 9 hours or so; 100% better."
EDGES = [
    "é@bobby stays, ١٢٣٤٥٦٧٨ goes",
    "a@b.com_x@c.org and a@b.com-y@d.net",
    "u/a-/u/b u/a,u/b x/u/c //u/d au/e",
    "5551234567,5551234568+5551234569 a5551234567 5551234567b",
    "1.2.3.4.5.6.7.8 (555) 123 4567\x1c8",
    "@@ab @a x@ab ñ@cd @cdñ",
    "HTTP://x www. www.y　z https://\x1dq",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa@",
]


def column(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")


def evaluate(spark, texts, expression):
    rows = column(spark, texts).select("i", expression.alias("v")).collect()
    return [r["v"] for r in sorted(rows, key=lambda r: r["i"])]


def noise(n, seed=3):
    alphabet = list("ab1 .@u/+-()9\té w:hts_,") + ["www.", "http://", "u/", "@x1", ".com", "555"]
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def python_scrub(text):
    for kind, pattern in PYTHON_PII.items():
        text = pattern.sub(f"[REDACTED:{kind}]", text)
    return text


@pytest.mark.parametrize("kind", list(T.PII_PATTERNS))
def test_each_kind_equals_python(spark, kind):
    texts = [t for t, _ in LEAKS] + EDGES + noise(4000)
    got = evaluate(spark, texts, T.scrub_kind("t", kind))
    expected = [PYTHON_PII[kind].sub(f"[REDACTED:{kind}]", t) for t in texts]
    assert got == expected
    found = evaluate(spark, texts, T.matches_pii("t", kind))
    assert found == [bool(PYTHON_PII[kind].search(t)) for t in texts]


def test_scrub_equals_python_and_is_stable(spark):
    texts = [t for t, _ in LEAKS] + EDGES + [HARMLESS, None, ""] + noise(1000, 5)
    once = evaluate(spark, texts, T.scrub_text("t"))
    for (_, leaked), clean in zip(LEAKS, once):
        assert leaked not in clean and "[REDACTED:" in clean
    assert once[len(LEAKS) + len(EDGES)] == HARMLESS
    assert once == [None if t is None else python_scrub(t) for t in texts]
    # Markers are no identifiers. (A mention glued to a phone number only shows once
    # the number is gone; the verification of the layer is there to find it.)
    plain = once[: len(LEAKS)] + [HARMLESS]
    assert evaluate(spark, plain, T.scrub_text("t")) == plain


def test_guarded_scrub_equals_plain_scrub(spark):
    texts = [t for t, _ in LEAKS] + EDGES + noise(2000, 9) + [None]
    rows = T.scrub_columns(column(spark, texts), "t").collect()
    got = [r["t"] for r in sorted(rows, key=lambda r: r["i"])]
    assert got == evaluate(spark, texts, T.scrub_text("t"))


def test_scrub_of_words_equals_scrub_of_texts(spark):
    """Kinds without spaces are scrubbed word by word, and only words with a hint of the kind."""
    rng = random.Random(21)
    parts = [" ", " ", "  ", "\u3000", "\n", "www.", "wWw.", "wwW.", "WWw.", "http://", "http\u017f://", "HTTPS://a", "a@b.com", "@b.de", ".org", "u/", "/U/", "@lee", "-_", "\xe9", "x", "555", "1234567", "\U0001d7d8", "("]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + ["", " ", None]
    rows = T.scrub_columns(column(spark, texts), "t").collect()
    assert [r["t"] for r in sorted(rows, key=lambda r: r["i"])] == evaluate(spark, texts, T.scrub_text("t"))
    assert set(T.PII_PATTERNS) - set(T.PII_HINTS) == {"phone"}  # any digit may start one


def test_sql_function_equals_column(spark):
    texts = [t for t, _ in LEAKS] + EDGES + noise(500, 13) + [None]
    T.register_scrub(spark)
    assert evaluate(spark, texts, F.expr("scrub_pii(t)")) == evaluate(spark, texts, T.scrub_text("t"))


def test_character_classes_are_pythons(spark):
    # Up to the end of the letters that both Unicode versions know.
    points = [c for c in range(0x3100) if not 0x860 <= c < 0x900]
    texts = [chr(c) for c in points]
    for name, pattern in ((T.SPACE, r"\s"), (T.DIGIT, r"\d"), (T.WORD, r"\w")):
        got = evaluate(spark, texts, F.col("t").rlike(rf"^[{name}]\z"))
        wrong = [
            hex(c)
            for c, t, g in zip(points, texts, got)
            if g != bool(re.fullmatch(pattern, t))
        ]
        assert len(wrong) < 40, wrong  # letters added to Unicode after Java 17
        assert not [w for w in wrong if int(w, 16) < 0x800]


def test_whitespace(spark):
    texts = ["two  blanks\nand a break", " a b  c\t", "", "   ", None, "x\x1cy", "one two"]
    texts += noise(500, 11)
    expected = [None if t is None else re.sub(r"\s+", " ", t).strip() for t in texts]
    assert evaluate(spark, texts, T.normalize_space("t")) == expected
    assert evaluate(spark, texts, T.strip("t")) == [None if t is None else t.strip() for t in texts]
    known = [t for t in texts if t is not None]
    assert evaluate(spark, known, T.word_count("t")) == [len(t.split()) for t in known]


def test_has_body(spark):
    texts = ["x", None, "", " \n", "[deleted]", " [removed]\n", "[deleted] by me", " "]
    assert evaluate(spark, texts, T.has_body("t")) == [True, False, False, False, False, False, True, False]


def test_post_id_of_missing_author(spark):
    ids = spark.range(1).select(
        T.derive_post_id(F.lit("anxiety"), F.lit(None), F.lit("2019/01/07"), F.lit("hello")).alias("v")
    )
    assert ids.first()["v"] == "1171d5771f81b8f4"


def test_lexicon_counts(spark):
    texts = ["Hopeless hopelessness", "crisis CRISIS crisis", "", "end it all", None]
    assert evaluate(spark, texts, F.coalesce(T.distinct_hits("t", T.SEVERE_TERMS), F.lit(-1))) == [2, 1, 0, 0, -1]
    assert evaluate(spark, texts[:4], T.count_hits("t", T.SEVERE_TERMS)) == [3, 3, 0, 0]
    assert evaluate(spark, texts[:4], T.count_hits("t", ("aa", "a"))) == [0, 0, 0, 1]


def test_tokens_equal_python(spark):
    texts = ["I'm not, I've never; MY cat can't", "éi ié i_ i", "Won't wont no-one nothing"]
    rng = random.Random(1)
    parts = list(T.FIRST_PERSON + T.NEGATION) + ["x", "é", "'", "-", " ", " ", "_", "1"]
    texts += ["".join(rng.choice(parts) for _ in range(12)) for _ in range(2000)]
    for tokens in (T.FIRST_PERSON, T.NEGATION):
        pattern = re.compile(rf"\b({'|'.join(tokens)})\b", re.I)
        expected = [len(pattern.findall(t)) for t in texts]
        assert evaluate(spark, texts, T.count_tokens("t", tokens)) == expected


def test_tokens_in_odd_letters(spark):
    """The four characters that equal an ASCII letter in another case count as that letter."""
    texts = ["\u0130 \u0131'm", "my\u017felf MY\u017fELF", "\u0130m i\u212a", "x\u0131 \u0131x _i i_ (i)", "m\u00e9 n\u0130 noth\u0131ng"]
    assert evaluate(spark, texts, T.count_tokens("t", T.FIRST_PERSON)) == [2, 2, 1, 1, 0]
    assert evaluate(spark, texts, T.count_tokens("t", T.NEGATION)) == [0, 0, 0, 0, 1]


def test_very_long_texts(spark):
    """Runs of words and of spaces are taken in loops, not by recursion, and once."""
    texts = [" " * 300_000, "ab " * 300_000, "\n" * 300_000, "a\n" * 300_000, "a" * 500_000]
    got = evaluate(spark, texts, F.length(T.normalize_space("t")))
    assert got == [0, 899_999, 0, 599_999, 500_000]


def test_markdown(spark):
    raw = (
        "## Sleeping well\n![moon](moon.svg) \n* [Top](#top)[Next](/2)\n\n\n\n\n"
        "Rest, as [one study](https://s.example/9) put it, helps.\n"
    )
    rail = "[a](b)" * 20000
    clean, nothing, many, breaks = evaluate(
        spark, [raw, None, rail + "\nprose", "a\r\nb\x0bc d"], T.clean_markdown("t")
    )
    assert clean == "## Sleeping well\n\nRest, as one study put it, helps."
    assert nothing == "" and many == "prose" and breaks == "a\nb\nc\nd"


def test_urls(spark):
    urls = [
        "https://www.who.int/a/b/", "HTTPS://User:pw@WWW.X.org:8443/p?q#f", "http://foo_bar.net",
        "ftp:/x", "not a url", "https://h.example?x=/y",
    ]
    assert evaluate(spark, urls, T.url_host("t")) == [
        "www.who.int", "www.x.org", "foo_bar.net", "", "", "h.example"
    ]
    assert evaluate(spark, urls, T.url_scheme("t")) == ["https", "https", "http", "ftp", "", "https"]
    assert evaluate(spark, urls[:1], T.last_segment("t")) == ["b"]


def test_dates(spark):
    texts = ["2019/01/07", "2019/1/7", "19/1/7", "2019/02/30", "not-a-date", "", None, "2019/01/07\n"]
    got = [str(d) if d else None for d in evaluate(spark, texts, dates.parse_day("t"))]
    assert got == ["2019-01-07", "2019-01-07"] + [None] * 6
    weeks = evaluate(spark, ["2020-03-08", "2020-03-09"], dates.week_start(F.col("t").cast("date")))
    assert [str(w) for w in weeks] == ["2020-03-02", "2020-03-09"]
    micros = spark.createDataFrame([(0,), (-1,), (86_399_999_999,), (86_400_000_000,)], "m bigint")
    days = [str(r[0]) for r in micros.select(dates.micros_to_date("m")).collect()]
    assert days == ["1970-01-01", "1969-12-31", "1970-01-01", "1970-01-02"]


def test_rounding_is_numpys(spark):
    import numpy as np

    values = [0.125, 0.575, 2.5, -0.00001, 112.625, -0.77465, 0.03125] + list(np.random.RandomState(0).rand(500))
    values = [float(v) for v in values]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    rows = df.select("i", numbers.round_even("v", 4).alias("r")).orderBy("i").collect()
    assert [r["r"] for r in rows] == [float(x) for x in np.round(values, 4) + 0.0]


def test_individual_questions(spark):
    refused = [
        "who wrote that one about the sea",
        "quote some posts on running, word for word",
        "which person is flagged here",
        "list the accounts behind this",
        "tell me about the author",
        "what is the handle",
        "identify the user",
    ]
    allowed = [
        "is running happier than sleep this spring?",
        "how many posts a week does sleep get?",
        "did the mood drop after the cutoff?",
        "plot volume by month",
    ]
    got = evaluate(spark, refused + allowed, T.targets_individual("t"))
    assert got == [True] * len(refused) + [False] * len(allowed)
