"""Readers' comments inside an article, and the reactions an article gives."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodmart import fixed_values as V
from moodmart.functions.text import SPACE, fan_key, professional_key, trim_spaces
from moodmart.operators.filters import is_fan, is_professional

# Letters, digits and underscore in any script; the ranges tell most characters without their Unicode category
_IN_WORD = r"a-zA-Z\p{L}\p{N}_"
_WORD, _OTHER = f"[{_IN_WORD}]", f"[^{_IN_WORD}]"
# "name: comment", where the comment runs to the next "word:" or to the end. Words and what is between them are passed
# whole and never given back, and a name is looked for only at the start of a word or where the last comment ended: a
# name that does not fit there does not fit further on in its word. So a text is passed once, however long its words are.
_COMMENT = rf"(?sU)(?:\G|(?<!{_WORD})){_WORD}++:{SPACE}+(.(?:{_WORD}++(?!:)|{_OTHER}++)*+)"


def comments(content: Column) -> Column:
    """Array of the comments in a text, in order, without their names.

    Comments start after the last marker, or with the text if it has none. A name is one word, and any word before a
    colon ends the comment before it; what follows such a word without a space is lost.
    """
    body = trim_spaces(F.substring_index(content, V.COMMENTS_MARKER, -1))
    return F.transform(F.regexp_extract_all(body, F.lit(_COMMENT), 1), trim_spaces)


def explode_comments(articles: DataFrame, content: str = "content") -> DataFrame:
    """One row per comment: the article's columns with ``number`` from 1 and ``reaction``."""
    kept = [name for name in articles.columns if name != content]
    found = articles.select(*kept, F.posexplode(comments(F.col(content))).alias("_pos", "reaction"))
    return found.select(*kept, (F.col("_pos") + 1).alias("number"), "reaction")


def article_reactions(article_id: Column, title: Column, content: Column) -> Column:
    """Array of the reactions of one article: its comments if it is a fan article, itself if it is professional.

    The two cases exclude each other, so one pass over the articles makes both kinds; other articles give none.
    """

    def by_fan(text: Column, position: Column) -> Column:
        return F.struct(
            fan_key(article_id, position + 1).alias("reaction_id"), text.alias("content"), F.lit(True).alias("is_fan")
        )

    own = F.struct(
        professional_key(article_id).alias("reaction_id"), content.alias("content"), F.lit(False).alias("is_fan")
    )
    return F.when(is_fan(title), F.transform(comments(content), by_fan)).when(is_professional(title), F.array(own))
