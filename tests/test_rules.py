"""One hand-made case per rule; expectations are written by hand."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from moodmart.functions import dates, labels, text
from moodmart.functions.html import PageSelectors, with_page_fields
from moodmart.operators import filters, reactions
from moodmart.plans import gold

HEADLINE = '<span class="a ssrcss-189b1h2-HeadlineWrap b">'
PARAGRAPH = '<p class="ssrcss-1q0x1qg-Paragraph e1jhz7w10">'


def headline(title, date=None):
    stamp = (
        f'<span class="t" data-testid="timestamp"><i>x</i><span data-testid="accessible-timestamp">{date}</span></span>'
        if date
        else ""
    )
    return f"{HEADLINE}<span role='text'>{title}</span>{stamp}</span>"


def values(frame):
    return [tuple(row) for row in frame.collect()]


def one(spark, column):
    return spark.range(1).select(column).first()[0]


PAGES = {
    "last headline wins": (
        f"<article>{headline('A', 'd1')}{PARAGRAPH}x</p></article>"
        f"<article>{headline('B', 'd2')}{PARAGRAPH}y</p></article>",
        ("d2", "B", "y"),
    ),
    "paragraph above the headline": (
        f"<article>{PARAGRAPH}pre</p>{headline('T', 'd')}{PARAGRAPH}a <b>b</b></p></article>",
        ("d", "T", "pre a b"),
    ),
    "no timestamp": (f"<article>{headline('T')}{PARAGRAPH}a</p></article>", ("No date found", "T", "a")),
    "timestamp without text": (
        f"<article>{HEADLINE}<span>T</span><span data-testid='timestamp'></span></span>{PARAGRAPH}a</p></article>",
        ("No date found", "T", "a"),
    ),
    "no headline": ("<html><p>nothing</p></html>", ("No date found", "No title found", "No content found")),
    "headline outside an article": (f"{headline('T', 'd')}{PARAGRAPH}a</p>", ("d", "T", "No content found")),
    "headline after an article": (
        f"<article>{PARAGRAPH}a</p></article>{headline('T', 'd')}{PARAGRAPH}b</p>",
        ("d", "T", "No content found"),
    ),
    "last headline lacks date": (
        f"<article>{headline('A', 'd1')}{PARAGRAPH}x</p></article><article>{headline('B')}{PARAGRAPH}y</p></article>",
        ("No date found", "B", "y"),
    ),
    "headline without inner element": (
        f"<article>{HEADLINE}bare</span><span>later</span>{PARAGRAPH}a</p></article>",
        ("No date found", "No title found", "a"),
    ),
    "title keeps its nested text": (
        f"<article>{HEADLINE}<span>One <span>&amp; two</span> three</span><span>no</span></span></article>",
        ("No date found", "One & two three", "No content found"),
    ),
    "date outside the headline does not count": (
        f"<article>{headline('T')}<span data-testid='timestamp'><span data-testid='accessible-timestamp'>d</span>"
        f"</span>{PARAGRAPH}a</p></article>",
        ("No date found", "T", "a"),
    ),
    "other paragraphs": (
        f"<article>{headline('T', 'd')}<p>no</p><p class='e1jhz7w10'>no</p>{PARAGRAPH}yes</p>"
        "<p class='ssrcss-1q0x1qg-Paragraph e1jhz7w10 more'>no</p></article>",
        ("d", "T", "yes"),
    ),
    "class of another element": (
        f"<article>{headline('T', 'd')}</article><span class='ssrcss-189b1h2-HeadlineWrapper'><span>U</span></span>",
        ("d", "T", "No content found"),
    ),
    "hidden markup": (
        f"<article>{headline('T', 'd')}{PARAGRAPH}a</p></article><!-- {headline('C', 'c')} -->"
        f"<script>var s = \"{headline('S', 's').replace(chr(34), chr(39))}</article>\"</script>",
        ("d", "T", "a"),
    ),
    "character references": (
        f"<article>{headline('T', 'd')}{PARAGRAPH}&lt;a&gt; &quot;b&quot; &#39;c&#39;&nbsp;&amp;lt; d</p></article>",
        ("d", "T", "<a> \"b\" 'c'\xa0&lt; d"),
    ),
    "capital letters": (
        f"<ARTICLE>{headline('T', 'd').replace('span', 'SPAN')}"
        "<P class='ssrcss-1q0x1qg-Paragraph e1jhz7w10'>a</P></ARTICLE>",
        ("d", "T", "a"),
    ),
    "signs that are no tags": (
        f"<article>{headline('T', 'd')}{PARAGRAPH}2 < 3 and 5 > 4 end</p>{PARAGRAPH}I <3 this club, <b>truly</b> yes</p>"
        f"{PARAGRAPH}a<img alt=\"x > y\">b<br/>c</p></article>",
        ("d", "T", "2 < 3 and 5 > 4 end I <3 this club, truly yes abc"),
    ),
    "a sign inside an attribute of the tags looked for": (
        f"<article data-x='a > b'>{headline('T', 'd')}<p data-y=\"1 > 0\" class='ssrcss-1q0x1qg-Paragraph e1jhz7w10'>a</p></article>",
        ("d", "T", "a"),
    ),
    "numeric and further named references": (
        f"<article>{headline('T', 'd')}{PARAGRAPH}it&#8217;s caf&eacute; &#x1F600; &#0; &#xD800; &#99999999; &unknown; &#x; &a</p></article>",
        ("d", "T", "it’s café \U0001F600 \ufffd \ufffd \ufffd &unknown; &#x; &a"),
    ),
    "open paragraphs": (
        f"<article>{headline('T', 'd')}{PARAGRAPH}one{PARAGRAPH}two</p>{PARAGRAPH}three</article>{PARAGRAPH}no</p>",
        ("d", "T", "one two three"),
    ),
    "an article in an article": (
        f"<article>{headline('T', 'd')}{PARAGRAPH}one</p><article>{PARAGRAPH}in</p></article>{PARAGRAPH}three</p></article>{PARAGRAPH}no</p>",
        ("d", "T", "one in three"),
    ),
    "an article before the headline in its article": (
        f"<article>{PARAGRAPH}no</p></article><article>{PARAGRAPH}one</p><article>{PARAGRAPH}in</p></article>"
        f"{headline('T', 'd')}{PARAGRAPH}three</p></article>",
        ("d", "T", "one in three"),
    ),
    "empty": ("", ("No date found", "No title found", "No content found")),
}


@pytest.mark.parametrize("case", PAGES)
def test_page_fields(spark, case):
    html, expected = PAGES[case]
    frame = spark.createDataFrame([(html,)], "html string")
    assert values(with_page_fields(frame).drop("html")) == [expected]


def test_page_fields_of_other_markup(spark):
    selectors = PageSelectors(headline_tag="h1", headline_class=None, title_tag=None, paragraph_class=None)
    frame = spark.createDataFrame([("<article><h1 id='x'>T <b>U</b></h1><p>a</p><pre>n</pre><p>b</p></article>",)], "html string")
    assert values(with_page_fields(frame, selectors=selectors).drop("html")) == [("No date found", "T U", "a b")]


DAY = dt.date


@pytest.mark.parametrize(
    "written, fetched, expected",
    [
        ("published at 22:46 2 October", "2024-10-03 10:46:15", DAY(2024, 10, 2)),
        ("22:46 2 October", "2024-10-02 23:00:00", DAY(2024, 10, 2)),
        ("  published at 9:05   12\tOCTOBER ", "2024-10-13 00:00:00", DAY(2024, 10, 12)),
        ("published at 22:46 30 December", "2025-01-02 06:00:00", DAY(2024, 12, 30)),
        ("published at 10:00 29 February", "2024-03-01 06:00:00", DAY(2024, 2, 29)),
        ("published at 10:00 29 February", "2025-03-01 06:00:00", None),
        ("published at 10:00 29 February", "2025-01-05 06:00:00", DAY(2024, 2, 29)),
        ("published at 10:00 31 April", "2025-05-01 06:00:00", None),
        ("published at 24:00 2 October", "2024-10-03 00:00:00", None),
        ("published at 22:60 2 October", "2024-10-03 00:00:00", None),
        ("published at 22:46 2 Oct", "2024-10-03 00:00:00", None),
        ("published at 22:46 October", "2024-10-03 00:00:00", None),
        ("published at 22:46 2 October 2024", "2024-10-03 00:00:00", None),
        ("published at 22:46 0 October", "2024-10-03 00:00:00", None),
        ("No date found", "2024-10-03 00:00:00", None),
        ("", "2024-10-03 00:00:00", None),
        (None, "2024-10-03 00:00:00", None),
    ],
)
def test_published_date(spark, written, fetched, expected):
    moment = F.lit(fetched).cast("timestamp_ntz")
    assert one(spark, dates.published_date(F.lit(written).cast("string"), moment)) == expected


def test_published_date_of_a_run_year(spark):
    late = dates.published_date(F.lit("22:46 30 December"), F.lit("2025-01-02 06:00:00"), F.lit(2025))
    assert one(spark, late) == DAY(2025, 12, 30)


def test_wall_clock(spark):
    winter = dates.wall_clock(F.lit("2024-01-15 23:30:00.7").cast("timestamp"))
    summer = dates.wall_clock(F.lit("2024-07-15 23:30:00").cast("timestamp"))
    assert one(spark, winter) == dt.datetime(2024, 1, 16, 0, 30)
    assert one(spark, summer) == dt.datetime(2024, 7, 16, 1, 30)


def test_run_timestamp_is_now(spark):
    from zoneinfo import ZoneInfo

    now = dt.datetime.now(ZoneInfo("Europe/Vienna")).replace(tzinfo=None)
    assert abs((one(spark, dates.run_timestamp()) - now).total_seconds()) < 60


def test_hash_and_names(spark):
    assert one(spark, text.text_hash(F.lit("é"))) == hashlib.sha256("é".encode()).hexdigest()
    assert one(spark, text.daily_name(F.lit("2024-10-03 10:46:15").cast("timestamp_ntz"))) == "epl_news_2024_10_03"
    assert one(spark, text.url_slug(F.lit("Brighton & Hove Albion"))) == "brighton-and-hove-albion"
    assert one(spark, text.trim_spaces(F.lit("　\x1c a b\xa0\n"))) == "a b"


def test_article_key(spark):
    whole = hashlib.sha256(b"Arsenal2024-10-02Title").hexdigest()
    key = text.article_key(F.lit("Arsenal"), F.lit("2024-10-02").cast("date"), F.lit("Title"))
    assert one(spark, key) == whole[:16]
    assert one(spark, text.article_key(F.lit("Arsenal"), F.lit(None).cast("date"), F.lit("Title"))) is None


def test_other_keys(spark):
    assert one(spark, text.title_key(F.lit("k"))) == "k_title"
    assert one(spark, text.professional_key(F.lit("k"))) == "k_pro"
    assert one(spark, text.fan_key(F.lit("k"), F.lit(3))) == "k_fan_3"
    assert one(spark, text.trend_key(F.lit(4), F.lit(2024), F.lit(1))) == "trend_4_2024_1"
    assert one(spark, text.trend_key(F.lit(4), F.lit(None).cast("int"), F.lit(1))) is None


def titles(spark, *rows):
    return spark.createDataFrame([(row,) for row in rows], "title string")


def test_live_coverage_titles(spark):
    kept = filters.drop_live_coverage(
        titles(
            spark,
            "Follow Monday's Carabao Cup",
            "Follow Sunday's Premier League games live",
            "Follow A v B",
            "Follow\xa0A\xa0v\xa0B",
            "Catch up on the Premier League action",
            "so who is your team facing? Tell us",
            "send us your thoughts",
            "Follow the money",
            "Send us your thoughts",
            "who is your team facing",
            None,
        )
    )
    assert sorted(values(kept)) == [("Follow the money",), ("Send us your thoughts",), ("who is your team facing",)]


def test_failed_pages(spark):
    pages = spark.createDataFrame(
        [("HTTP error 500",), ("HTTP error 404",), ("Failed after 3 attempts",), ("<p>HTTP error 500</p>",)],
        "html string",
    )
    assert values(filters.drop_failed_pages(pages)) == [("<p>HTTP error 500</p>",)]
    assert values(filters.legacy_keep_http_500(pages)) == [("HTTP error 500",)]


def test_title_routes(spark):
    rows = titles(spark, "X: the fans' verdict", "Gossip", "Did you kno X", "Did you know? X", "other", "gossip", None)
    assert values(filters.keep_fan(rows)) == [("X: the fans' verdict",)]
    assert sorted(values(filters.keep_professional(rows))) == [("gossip",), ("other",)]


MARKER = "Here are some of your comments:"
COMMENTS = {
    f"intro {MARKER} John Smith: Great win é! Zoë: it was 22:46 late. Bob:nope Al: see http://x.y ok": [
        "Great win é!",
        "it was",
        "see",
    ],
    "no marker Ann:  yes": ["yes"],
    f"Old: one {MARKER} Bo: two {MARKER} Cy: three": ["three"],
    f"{MARKER} Ann:\n first\nline \n Bob: second": ["first\nline", "second"],
    f"{MARKER} A: foo: bar": ["f", "bar"],
    f"{MARKER}\xa0Ann:\xa0hi　": ["hi"],
    f"{MARKER} x_1: under é: mark": ["under é: mark"],
    "x": [],
    "Ann: ": [],
    "": [],
}


@pytest.mark.parametrize("content", COMMENTS)
def test_comments(spark, content):
    assert one(spark, reactions.comments(F.lit(content))) == COMMENTS[content]


@pytest.mark.parametrize("content", COMMENTS)
def test_comments_equal_the_plain_regular_expression(spark, content):
    """The pattern has a possessive part and its own letter classes; Python's plain one must find the same."""
    import re

    body = content.split(MARKER)[-1].strip()
    plain = [found.strip() for _, found in re.findall(r"(?s)(\w+):\s+(.+?)(?=\w+:|$)", body)]
    assert one(spark, reactions.comments(F.lit(content))) == plain


def test_comments_pass_a_long_word_once(spark):
    """400,000 letters without a break; looking ahead to the word's end from each of them took minutes."""
    import time

    rows = spark.createDataFrame([(f"{MARKER} Ann: {'é' * 400_000} Bo: two {'a' * 400_000}",)], "content string")
    begin = time.monotonic()
    found = rows.select(F.transform(reactions.comments(F.col("content")), lambda text: F.length(text))).first()[0]
    assert found == [400_000, 400_004]
    assert time.monotonic() - begin < 30


def test_comments_are_numbered(spark):
    rows = spark.createDataFrame([("k", f"{MARKER} A: one B: two"), ("m", "none")], "id string, content string")
    assert sorted(values(reactions.explode_comments(rows))) == [("k", 1, "one"), ("k", 2, "two")]


def test_reaction_is_fan_and_professional_together(spark):
    articles = spark.createDataFrame(
        [
            ("t1", DAY(2024, 1, 1), "X: the fans' verdict", f"{MARKER} A: one B: two", "k1"),
            ("t2", DAY(2024, 1, 2), "Plain", "A: three", "k2"),
            ("t1", DAY(2024, 1, 3), "Gossip", "A: four", "k3"),
            ("t1", DAY(2024, 1, 3), "Did you kno", "A: five", "k4"),
            ("t1", DAY(2024, 1, 3), None, "A: six", "k5"),
            ("t9", DAY(2024, 1, 4), "No such team", "A: seven", "k6"),
        ],
        "teamName string, publishedDate date, title string, content string, id string",
    )
    teams = spark.createDataFrame([(1, "t1"), (2, "t2")], "team_id long, team_name string")
    together = values(gold.reaction(articles, teams))
    apart = values(gold.fan_reactions(articles, teams).unionByName(gold.pro_reactions(articles, teams)))
    assert sorted(together) == sorted(apart) == [
        ("k1_fan_1", "k1", 1, "one", DAY(2024, 1, 1), True),
        ("k1_fan_2", "k1", 1, "two", DAY(2024, 1, 1), True),
        ("k2_pro", "k2", 2, "A: three", DAY(2024, 1, 2), False),
    ]


@pytest.mark.parametrize(
    "score, expected",
    [
        (0.2, "neutral"),
        (-0.2, "neutral"),
        (0.21, "positive"),
        (-0.21, "negative"),
        (1.0, "positive"),
        (-1.0, "negative"),
        (1.5, "neutral"),
        (-1.5, "neutral"),
        (float("nan"), "neutral"),
    ],
)
def test_polarity_class(spark, score, expected):
    assert one(spark, labels.polarity_class(F.lit(score))) == expected


def test_polarity_band(spark):
    assert one(spark, labels.polarity_class(F.lit(0.2), 0.1)) == "positive"


@pytest.mark.parametrize(
    "score, expected", [(0.49, "objective"), (0.5, "subjective"), (1.0, "subjective"), (1.1, "objective")]
)
def test_subjectivity_class(spark, score, expected):
    assert one(spark, labels.subjectivity_class(F.lit(score))) == expected


def test_date_parts(spark):
    frame = spark.createDataFrame([(DAY(2024, 12, 30),), (DAY(2021, 1, 3),)], "d date")
    assert values(frame.select(*dates.date_parts(F.col("d")))) == [(2024, 12, 30, 1), (2021, 1, 3, 53)]
    assert values(frame.select(*dates.date_parts(F.col("d"), week_year=True))) == [(2025, 12, 30, 1), (2020, 1, 3, 53)]
