"""Random inputs against plain Python: comments, dates and page fields."""

import datetime as dt
import random
import re
from html.parser import HTMLParser

from pyspark.sql import functions as F

from moodmart import fixed_values as V
from moodmart.functions import dates
from moodmart.functions.html import with_page_fields
from moodmart.operators.reactions import comments


def test_comments(spark):
    source = random.Random(5)
    pieces = ["a", "Bob", "é", "Zoë", "_", "9", "½", "中", "é", ":", ":", ":", " ", " ", "\n", "\xa0", "\x1c", "-", ".",
              "http://x", "22:46", "Ann: ", " Al:\n", "Zoë: ", "x_1: "]
    texts = ["".join(source.choices(pieces, k=source.randint(0, 30))) for _ in range(3000)]
    texts = [text + source.choice(["", "", "", V.COMMENTS_MARKER + " Bo: hi"]) for text in texts]

    def plain(text):
        body = text.split(V.COMMENTS_MARKER)[-1].strip()
        return [found.strip() for _, found in re.findall(r"(?s)(\w+):\s+(.+?)(?=\w+:|$)", body)]

    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    found = [row[0] for row in frame.select(comments(F.col("text"))).collect()]
    wrong = [(text, got, plain(text)) for text, got in zip(texts, found) if got != plain(text)]
    assert wrong == []
    assert sum(len(got) > 1 for got in found) > 300


def test_published_dates(spark):
    source = random.Random(6)
    months = ["January", "february", "MARCH", "April", "May", "June", "July", "August", "September", "October",
              "November", "December", "Sept", "Mai"]
    rows = []
    for _ in range(3000):
        clock = f"{source.randint(0, 25)}:{source.randint(0, 61):0{source.choice([1, 2])}d}"
        words = [clock, str(source.randint(0, 32)), source.choice(months)]
        if source.random() < 0.1:
            source.shuffle(words)
        text = source.choice(["published at ", "", " "]) + source.choice([" ", "  ", "\t"]).join(words)
        fetched = dt.date(2023, 1, 1) + dt.timedelta(source.randint(0, 1200))
        rows.append((text, fetched, source.randint(2020, 2026)))

    def plain(text, year):
        words = text.replace("published at ", "").split()
        try:
            return dt.datetime.strptime(" ".join([*words, str(year)]), "%H:%M %d %B %Y").date() if len(words) == 3 else None
        except ValueError:
            return None

    def of_fetch(text, fetched):
        # a leap year tells whether the day comes later in the year than the fetch, also for 29 February
        anyhow = plain(text, 2000)
        if anyhow is None:
            return None
        later = (anyhow.month, anyhow.day) > (fetched.month, fetched.day)
        return plain(text, fetched.year - later)

    frame = spark.createDataFrame(rows, "text string, fetched date, year int")
    found = frame.select(
        "text",
        "fetched",
        "year",
        dates.published_date(F.col("text"), F.col("fetched")).alias("by_fetch"),
        dates.published_date(F.col("text"), F.col("fetched"), F.col("year")).alias("by_run"),
    ).collect()
    for row in found:
        assert row["by_run"] == plain(row["text"], row["year"]), row
        assert row["by_fetch"] == of_fetch(row["text"], row["fetched"]), row
    assert sum(row["by_fetch"] is not None for row in found) > 1000


class Tree(HTMLParser):
    """A document tree of nested lists: [tag, attributes, parent, children]."""

    def __init__(self, html):
        super().__init__()
        self.top = self.at = ["", {}, None, []]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attributes):
        node = [tag, dict(attributes), self.at, []]
        self.at[3].append(node)
        self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node[2] is not None and node[0] != tag:
            node = node[2]
        if node[2] is not None:
            self.at = node[2]

    def handle_data(self, data):
        self.at[3].append(data)


def descend(node):
    for child in node[3]:
        if isinstance(child, list):
            yield child
            yield from descend(child)


def text_of(node):
    return "".join(child if isinstance(child, str) else text_of(child) for child in node[3])


def plain_fields(html):
    date, title, content = V.NO_DATE, V.NO_TITLE, V.NO_CONTENT
    for node in descend(Tree(html).top):
        if node[0] != "span" or V.HEADLINE_CLASS not in node[1].get("class", "").split():
            continue
        spans = [inner for inner in descend(node) if inner[0] == "span"]
        title = text_of(spans[0]) if spans else V.NO_TITLE
        stamps = [
            text_of(inner)
            for outer in spans
            if outer[1].get("data-testid") == V.TIMESTAMP_TESTID
            for inner in descend(outer)
            if inner[0] == "span" and inner[1].get("data-testid") == V.TIMESTAMP_TEXT_TESTID
        ]
        date = stamps[0] if stamps else V.NO_DATE
        around = node
        while around is not None and around[0] != "article":
            around = around[2]
        paragraphs = [] if around is None else [
            text_of(inner) for inner in descend(around) if inner[0] == "p" and inner[1].get("class") == V.PARAGRAPH_CLASS
        ]
        content = " ".join(paragraphs) if paragraphs else V.NO_CONTENT
    return date, title, content


def random_page(source):
    def words():
        return " ".join(source.choices(["goal", "win &amp; draw", "&lt;3", "l'été", "<b>x</b>", "<i>y <em>z</em></i>",
            "2 < 3 > 1", "it&#8217;s", "&#x2014;&eacute;", "<img alt='a > b'>"], k=source.randint(0, 3)))

    def headline():
        title = source.choice(["", f"<span>{words()}</span>", f"<span class='q'>{words()} <span>{words()}</span></span>"])
        stamp = source.choice(
            [
                "",
                '<span data-testid="timestamp"></span>',
                f'<span class="s" data-testid="timestamp"><span aria-hidden="true">9h</span>'
                f'<span class="v" data-testid="accessible-timestamp">published at {source.randint(0, 23)}:10 2 May</span></span>',
            ]
        )
        order = title + stamp if source.random() < 0.9 else stamp + title
        return f'<span class="{source.choice(["", "k "])}{V.HEADLINE_CLASS}{source.choice(["", " j"])}">{source.choice(["", words()])}{order}</span>'

    def paragraph():
        kind = source.choice([V.PARAGRAPH_CLASS, V.PARAGRAPH_CLASS, V.PARAGRAPH_CLASS + " z", "other"])
        return f'<p class="{kind}">{words()}</p>'

    def inner_article():
        return f'<article data-x="1 > 0">{paragraph()}{paragraph()}</article>'

    def block():
        return source.choice([paragraph, paragraph, headline, inner_article, lambda: f"<div><span>{words()}</span>{paragraph()}</div>"])()

    def article():
        return f'<article class="a">{"".join(block() for _ in range(source.randint(1, 7)))}</article>'

    hidden = lambda: f"<!-- {headline()} --><script>var a = '<article>';</script>"
    parts = source.choices([article, article, article, paragraph, headline, hidden], k=source.randint(1, 6))
    return "<html><body>" + "".join(part() for part in parts) + "</body></html>"


def test_page_fields(spark):
    source = random.Random(7)
    pages = [random_page(source) for _ in range(1500)]
    frame = spark.createDataFrame([(html,) for html in pages], "html string").coalesce(8)
    found = [(row["publishedDate"], row["title"], row["content"]) for row in with_page_fields(frame).collect()]
    wrong = [(html, got, plain_fields(html)) for html, got in zip(pages, found) if got != plain_fields(html)]
    assert wrong[:1] == []
    assert len({got[0] for got in found}) > 5 and sum(got[2] != V.NO_CONTENT for got in found) > 300
