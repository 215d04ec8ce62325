"""Language identification with interpolated Kneser-Ney character models.

A text is lower-cased; everything that is no letter becomes one space per run. One model of order ``ORDER`` is learned
per language from the labelled training documents. N-grams are counted by the tasks over the whole of every training
text and summed by Spark; all of them belong to the model. From them the interpolated probabilities of every n-gram of
every order under every language are computed once.

There are two ways to look them up, with equal results. A model measured to fit (``GATHERED_CELLS``) is gathered into
arrays sorted by hash that every task holds, so that a text's cost is a lookup per character. A larger one is made by
aggregations and joins and stays dealt out over the executors: the different n-grams of the texts are joined with it,
and each text with those it has. Logarithms are rounded to multiples of 1 / ``LOG_STEPS``, so that their sums do not
depend on the order.

A document gets the language of the lowest cross-entropy per character. Rejection is calibrated on the training
documents: the excess of the cross-entropy over the language's mean, times the root of the length up to
``CALIBRATION_CHARS``, is compared with ``MARGIN`` times its ``QUANTILE`` among the training documents of the language.

Rules: a null text and a text without letters are ``und`` with score 0 and are rejected. Rows without a language, or
held out, teach nothing. If nothing can be learned, every document is ``und``. Repeated rows are scored alike. Only the
named columns are read; lang, source and doc_id are no inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodmart.llm.tables import free_name, row_key
from moodmart.llm.texts import PIECE_BYTES, mix
from moodmart.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, dimension_join
from moodmart.session import stage

ORDER = 4
# A model is gathered if its n-grams times (languages + 16) are at most so many, some 100 MB on the driver
GATHERED_CELLS = 8_000_000
LOG_STEPS = float(1 << 22)
CALIBRATION_CHARS = 100
QUANTILE = 0.999
MARGIN = 3.0
SCORE_CHARS = 20
FOLDS = 5

_PAD, _SPACE = 2, 32
_MULTIPLIER = np.uint64(0x9FB21C651E98DF25)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32(doc_id as text) mod 5 is 0; documents without an identifier are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


class Alphabet:
    """Which code points are letters, found once per task."""

    def __init__(self):
        self.letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, each after ORDER - 1 pads and ended by a space, and each symbol's text."""
        padded = [chr(_PAD) * (ORDER - 1) + text.lower() + " " for text in texts]
        codes = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), np.uint32)
        row = np.repeat(np.arange(len(texts)), [len(text) for text in padded])
        plain = self.letters[codes] | (codes == _PAD)
        keep = plain.copy()
        keep[1:] |= plain[:-1]
        return np.where(plain, codes, _SPACE)[keep].astype(np.uint64), row[keep]


def text_pieces(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of runs of rows with at most PIECE_BYTES characters, or of one row."""
    first, held, size = 0, [], 0
    for place in range(len(column)):
        text = column[place].as_py() or ""
        if held and size + len(text) > PIECE_BYTES:
            yield first, held
            first, held, size = place, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def gram_hashes(symbols: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` symbols that end at each place from ``size`` - 1 on."""
    total = symbols.size - size + 1
    value = np.full(max(total, 0), np.uint64(size), np.uint64)
    for step in range(size):
        value = value * _MULTIPLIER + symbols[step : step + total] + np.uint64(1)
    return mix(value)


def _counted(symbols: np.ndarray, row: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Group, n-gram of order ORDER and count of all n-grams of texts; ``group`` has a number below 2^22 per text."""
    total = max(0, symbols.size - ORDER + 1)
    # 21 bits hold any code point, so ORDER = 4 symbols take two numbers: a pair and the last two
    place = np.flatnonzero(row[:total] == row[ORDER - 1 :])
    head = (group[row[place]].astype(np.uint64) << np.uint64(42)) | (symbols[place] << np.uint64(21)) | symbols[place + 1]
    tail = (symbols[place + 2] << np.uint64(21)) | symbols[place + 3]
    hashed = mix(head * _MULTIPLIER + tail)
    order = np.argsort(hashed)
    hashed = hashed[order]
    new = np.ones(hashed.size, bool)
    new[1:] = hashed[1:] != hashed[:-1]
    begin = np.flatnonzero(new)
    one = place[order[begin]]
    joined = symbols[one[:, None] + np.arange(ORDER)].astype("<u4").tobytes().decode("utf-32-le")
    grams = [joined[i : i + ORDER] for i in range(0, len(joined), ORDER)]
    return group[row[one]], grams, np.diff(np.append(begin, hashed.size))


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of all n-grams of order ORDER of ``docs`` (lang, text); gram is a string of ORDER characters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet()
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for first, texts in text_pieces(batch.column("text")):
                names, code = np.unique(langs[first : first + len(texts)].astype(str), return_inverse=True)
                group, grams, n = _counted(*alphabet.symbols(texts), code)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[group].tolist(), pa.string()), pa.array(grams, pa.string()), pa.array(n, pa.int64())],
                    names=["lang", "gram", "n"],
                )

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, gram string, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class SortedHashes:
    """A sorted array of hashes with an index on their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys)
        self.keys = np.append(keys[self.order], np.uint64(0xFFFFFFFFFFFFFFFF))
        self.bits = max(4, int(keys.size).bit_length() + 3)
        heads = np.arange((1 << self.bits) + 1, dtype=object) << (64 - self.bits)
        heads = np.array([min(head, (1 << 64) - 1) for head in heads], np.uint64)
        self.start = np.searchsorted(self.keys[:-1], heads).astype(np.int32)
        self.steps = int(np.diff(self.start).max(initial=0))

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = self.start[(wanted >> np.uint64(64 - self.bits)).astype(np.int64)]
        for _ in range(self.steps):
            place = place + (self.keys[place] < wanted)
        return place, self.keys[place] == wanted


class Models:
    """Interpolated Kneser-Ney models of all languages over one table of n-grams."""

    def __init__(self, counts: pd.DataFrame):
        self.langs = sorted(counts["lang"].unique())
        width = len(self.langs)
        code = {lang: place for place, lang in enumerate(self.langs)}
        grams = pd.DataFrame({"lang": counts["lang"].map(code), "gram": counts["gram"], "n": counts["n"].astype(float)})
        orders = {ORDER: grams}
        for size in range(ORDER - 1, 0, -1):
            # Continuation counts: different symbols before the gram
            longer = orders[size + 1]
            orders[size] = (
                pd.DataFrame({"lang": longer["lang"], "gram": longer["gram"].str[1:], "n": 1.0})
                .groupby(["lang", "gram"], as_index=False)["n"]
                .sum()
            )
        symbols = max(1, orders[1]["gram"].nunique()) + 1
        self.unknown = float(_stepped(-np.log(symbols)))
        below, below_at = np.full((1, width), 1 / symbols), None
        keys, values, contexts, backoffs = [], [], [], []
        for size in range(1, ORDER + 1):
            table = orders[size]
            names = pd.Index(table["gram"].unique())
            at = names.get_indexer(table["gram"])
            seen = np.zeros((len(names), width))
            seen[at, table["lang"]] = table["n"]
            heads = pd.Index(names.str[:-1].unique())
            head_at = heads.get_indexer(names.str[:-1])
            total, kinds = np.zeros((len(heads), width)), np.zeros((len(heads), width))
            np.add.at(total, head_at, seen)
            np.add.at(kinds, head_at, (seen > 0).astype(float))
            once, twice = (seen == 1).sum(axis=0), (seen == 2).sum(axis=0)
            discount = np.where((once > 0) & (twice > 0), once / np.maximum(1, once + 2 * twice), 0.5)
            with np.errstate(divide="ignore", invalid="ignore"):
                weight = np.where(total > 0, discount * kinds / total, 1.0)
                own = np.where(total[head_at] > 0, np.maximum(seen - discount, 0) / total[head_at], 0.0)
            lower = below[below_at.get_indexer(names.str[1:])] if below_at is not None else below
            value = own + weight[head_at] * lower
            keys.append(_hash_strings(names, size))
            values.append(_stepped(np.log(value)))
            contexts.append(_hash_strings(heads, size - 1))
            backoffs.append(_stepped(np.log(weight)))
            below, below_at = value, names
        self.grams, self.contexts = SortedHashes(np.concatenate(keys)), SortedHashes(np.concatenate(contexts))
        self.values = np.concatenate(values)[self.grams.order]
        self.backoffs = np.concatenate(backoffs)[self.contexts.order]

    def entropy(self, symbols: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in nats per symbol of each row under each language, and the number of symbols scored."""
        scored = np.flatnonzero(symbols != _PAD)
        scored = scored[scored >= ORDER - 1]
        logs = np.zeros((scored.size, len(self.langs)))
        left = np.arange(scored.size)
        hashes = gram_hashes(symbols, ORDER)
        for size in range(ORDER, 0, -1):
            if size < ORDER:
                hashes = gram_hashes(symbols, size)
            place, known = self.grams.find(hashes[scored[left] - size + 1])
            logs[left[known]] += self.values[place[known]]
            left = left[~known]
            if not left.size:
                break
            before = gram_hashes(symbols, size - 1) if size > 1 else None
            wanted = before[scored[left] - size + 1] if size > 1 else np.full(left.size, _hash_strings([""], 0)[0])
            place, known = self.contexts.find(wanted)
            logs[left[known]] += self.backoffs[place[known]]
        logs[left] += self.unknown
        count = np.bincount(row[scored], minlength=rows)
        first = np.concatenate([[0], np.cumsum(count)])[:-1]
        sums = np.zeros((rows, len(self.langs)))
        filled = count > 0
        if filled.any():
            sums[filled] = np.add.reduceat(logs, first[filled], axis=0)
        return -sums / np.maximum(1, count)[:, None], count


def _stepped(logs: np.ndarray) -> np.ndarray:
    return np.rint(logs * LOG_STEPS) / LOG_STEPS


def _hash_strings(strings, size: int) -> np.ndarray:
    """As gram_hashes, for strings of ``size`` symbols."""
    symbols = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32).astype(np.uint64).reshape(len(strings), size)
    value = np.full(len(strings), np.uint64(size), np.uint64)
    for step in range(size):
        value = value * _MULTIPLIER + symbols[:, step] + np.uint64(1)
    return mix(value)


class DealtModels:
    """The same models as tables: per order the logarithms of n-grams and of back-off weights, a row per n-gram."""

    def __init__(self, counts: DataFrame, langs: list[str]):
        self.langs = langs
        # A row holds a number per language, which measuring does not see
        self.rows = min(BROADCAST_ROWS, BROADCAST_BYTES // (8 * len(langs) + 100))
        orders = {ORDER: counts}
        for size in range(ORDER - 1, 0, -1):
            # Continuation counts: different symbols before the gram
            longer = orders[size + 1].select("lang", F.substring("gram", 2, size).alias("gram"))
            orders[size] = stage(longer.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n")))
        symbols = max(1, orders[1].select("gram").distinct().count()) + 1
        self.unknown = float(_stepped(-np.log(symbols)))
        names = F.array(*[F.lit(lang) for lang in langs])
        self.grams, self.contexts, lower = {}, {}, None
        for size in range(1, ORDER + 1):
            table = orders[size]
            rare = table.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"))
            # One row per language
            found = {row["lang"]: (row["once"], row["twice"]) for row in rare.collect()}
            discounts = [once / (once + 2 * twice) if once and twice else 0.5 for once, twice in map(found.get, langs)]
            discount = F.array(*[F.lit(x) for x in discounts])

            def per_lang(entries: Column, name: str) -> Column:
                by_lang = F.map_from_entries(F.collect_list(F.struct("lang", entries)))
                return F.transform(names, lambda lang: F.coalesce(F.try_element_at(by_lang, lang), F.lit(0))).alias(name)

            heads = table.groupBy("lang", F.substring("gram", 1, size - 1).alias("head")).agg(
                F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")
            )
            heads = heads.groupBy("head").agg(per_lang(F.col("total"), "total"), per_lang(F.col("kinds"), "kinds"))
            heads = stage(
                heads.select(
                    "head", "total",
                    F.transform(
                        discount,
                        lambda d, i: F.when(F.get("total", i) > 0, d * F.get("kinds", i) / F.get("total", i)).otherwise(1.0),
                    ).alias("weight"),
                )
            )
            seen = table.groupBy("gram").agg(per_lang(F.col("n"), "seen"))
            seen = seen.select("*", F.substring("gram", 1, size - 1).alias("head"), F.substring("gram", 2, size - 1).alias("tail"))
            seen = dimension_join(seen, heads, "head", max_rows=self.rows)
            if lower is None:
                seen = seen.withColumn("lower", F.array_repeat(F.lit(1 / symbols), len(langs)))
            else:
                seen = dimension_join(seen, lower.select(F.col("gram").alias("tail"), F.col("value").alias("lower")), "tail", max_rows=self.rows)

            def value(d: Column, i: Column) -> Column:
                own = F.when(F.get("total", i) > 0, F.greatest(F.get("seen", i) - d, F.lit(0.0)) / F.get("total", i)).otherwise(0.0)
                return own + F.get("weight", i) * F.get("lower", i)

            lower = stage(seen.select("gram", F.transform(discount, value).alias("value")))
            logs = lambda name: F.transform(name, lambda x: F.rint(F.log(x) * LOG_STEPS) / LOG_STEPS)
            self.grams[size] = lower.select("gram", logs("value").alias("value"))
            self.contexts[size - 1] = heads.select("head", logs("weight").alias("backoff"))

    def resolved(self, grams: DataFrame) -> DataFrame:
        """Different n-grams of order ORDER (gram) with their logarithm per language (logs)."""

        def add(a: Column, b: Column) -> Column:
            return F.zip_with(a, b, lambda x, y: x + y)

        frame, width = grams, len(self.langs)
        for size in range(ORDER, 0, -1):
            frame = frame.withColumns(
                {"_gram": F.substring("gram", ORDER - size + 1, size), "_head": F.substring("gram", ORDER - size + 1, size - 1)}
            )
            known = self.grams[size].select(F.col("gram").alias("_gram"), F.col("value").alias(f"_value{size}"))
            before = self.contexts[size - 1].select(F.col("head").alias("_head"), F.col("backoff").alias(f"_backoff{size}"))
            frame = dimension_join(frame, known, "_gram", "left", max_rows=self.rows).drop("_gram")
            frame = dimension_join(frame, before, "_head", "left", max_rows=self.rows).drop("_head")
        logs = F.array_repeat(F.lit(self.unknown), width)
        none = F.array_repeat(F.lit(0.0), width)
        for size in range(1, ORDER + 1):
            logs = F.coalesce(F.col(f"_value{size}"), add(F.coalesce(F.col(f"_backoff{size}"), none), logs))
        return frame.select("gram", logs.alias("logs"))


def learn(docs: DataFrame, gathered_cells: int = GATHERED_CELLS) -> Models | DealtModels | None:
    """Models from labelled ``docs`` (lang, text); None if there is nothing to learn from."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = stage(gram_counts(known))
    # One row per language
    sizes = {row["lang"]: row["count"] for row in counts.groupBy("lang").count().collect()}
    if not sizes:
        return None
    if sum(sizes.values()) * (len(sizes) + 16) <= gathered_cells:
        return Models(counts.toArrow().to_pandas())
    return DealtModels(counts, sorted(sizes))


def _dealt_entropies(docs: DataFrame, models: DealtModels) -> DataFrame:
    """As _entropies, by joins. Texts are told apart by their key; copies of a text add alike to its sums and count."""
    parts = ("key_text", "key_check")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet()
        for batch in batches:
            for first, texts in text_pieces(batch.column("text")):
                group, grams, n = _counted(*alphabet.symbols(texts), np.arange(len(texts)))
                # A pad character that the text itself holds is no symbol to score
                scored = np.array([gram[-1] != chr(_PAD) for gram in grams], bool)
                group, grams, n = group[scored], list(compress(grams, scored)), n[scored]
                keys = [batch.column(part).take(pa.array(first + group)) for part in parts]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(grams, pa.string()), pa.array(n, pa.int64())], names=[*parts, "gram", "n"]
                )

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet()
        for batch in batches:
            kept = batch.drop_columns(["text"])
            for first, texts in text_pieces(batch.column("text")):
                symbols, row = alphabet.symbols(texts)
                scored = np.bincount(row[symbols != _PAD], minlength=len(texts))
                letters = np.bincount(row[(symbols != _PAD) & (symbols != _SPACE)], minlength=len(texts))
                n = pa.array(np.where(letters > 0, scored, 0), pa.int64())
                yield pa.RecordBatch.from_arrays([*kept.slice(first, len(texts)).columns, n], names=[*kept.schema.names, "n"])

    uses = stage(docs.select(*parts, "text").mapInArrow(count, "key_text bigint, key_check bigint, gram string, n bigint"))
    resolved = stage(models.resolved(uses.select("gram").distinct()))
    sums = (
        dimension_join(uses, resolved, "gram", max_rows=models.rows)
        .groupBy(*parts)
        .agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * F.get("logs", F.lit(i))).alias(f"s{i}") for i in range(len(models.langs))])
    )
    means = F.array(*[-F.col(f"s{i}") / F.col("n") for i in range(len(models.langs))])
    entropies = stage(sums.select(F.struct(*parts).alias("_text_key"), means.alias("entropies")))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    counted = docs.mapInArrow(lengths, f"{schema}, n bigint").withColumn("_text_key", F.struct(*parts))
    return dimension_join(counted, entropies, "_text_key", max_rows=models.rows).drop("_text_key")


def _entropies(docs: DataFrame, models: Models | DealtModels) -> DataFrame:
    """``docs`` without text, with n (symbols scored; 0 without letters) and entropies, one per language."""
    if isinstance(models, DealtModels):
        return _dealt_entropies(docs, models)
    # As bytes, since the models' class travels with them
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(models))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, known = Alphabet(), cloudpickle.loads(shared.value)
        for batch in batches:
            kept = batch.drop_columns(["text"])
            for first, texts in text_pieces(batch.column("text")):
                symbols, row = alphabet.symbols(texts)
                entropy, count = known.entropy(symbols, row, len(texts))
                letters = np.bincount(row[(symbols != _PAD) & (symbols != _SPACE)], minlength=len(texts))
                count = np.where(letters > 0, count, 0)
                part = kept.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(count, pa.int64()), pa.array(entropy.tolist(), pa.list_(pa.float64()))],
                    names=[*part.schema.names, "n", "entropies"],
                )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(score, f"{schema}, n bigint, entropies array<double>")


def _key_parts() -> list[Column]:
    """The row key as plain columns, for tasks that copy them."""
    return [row_key()[part].alias(f"key_{part}") for part in ("id", "text", "check")]


def _key() -> Column:
    return F.struct(*[F.col(f"key_{part}").alias(part) for part in ("id", "text", "check")]).alias("key")


def identify(docs: DataFrame, gathered_cells: int = GATHERED_CELLS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): doc_id, key, held_out, lang_pred, score, n, entropy, rejected.

    Learns from the rows that are not held out and have a language. ``gathered_cells`` only says how models are looked up.
    """
    named = docs.select("doc_id", "text", "lang", held_out().alias("held_out"), *_key_parts())
    models = learn(named.where(~F.col("held_out")), gathered_cells)
    unknown = (
        F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n"),
        F.lit(None).cast("double").alias("entropy"), F.lit(True).alias("rejected"),
    )
    if models is None:
        return named.select("doc_id", _key(), "held_out", *unknown)
    langs = F.array(*[F.lit(lang) for lang in models.langs])
    least = F.array_min("entropies")
    reach = F.sqrt(F.least(F.col("n"), F.lit(CALIBRATION_CHARS)))
    weight = F.least(F.col("n"), F.lit(SCORE_CHARS))
    scored = stage(_entropies(named, models)).select(
        "doc_id", _key(), "held_out", "lang", "n",
        F.when(F.col("n") > 0, F.element_at(langs, F.array_position("entropies", least).cast("int"))).alias("guess"),
        F.when(F.col("n") > 0, least).alias("entropy"),
        F.aggregate(F.transform("entropies", lambda e: F.exp((least - e) * weight)), F.lit(0.0), lambda a, x: a + x).alias("mass"),
        reach.alias("reach"),
    )
    learned = scored.where(~F.col("held_out") & (F.col("guess") == F.col("lang")))
    means = learned.groupBy("guess").agg(F.avg("entropy").alias("mean"))
    # One row per language
    limits = stage(
        learned.join(F.broadcast(means), "guess")
        .groupBy("guess")
        .agg(
            F.first("mean").alias("mean"),
            F.percentile_approx((F.col("entropy") - F.col("mean")) * F.col("reach"), QUANTILE, 10_000).alias("limit"),
        )
    )
    excess = (F.col("entropy") - F.col("mean")) * F.col("reach")
    return scored.join(F.broadcast(limits), "guess", "left").select(
        "doc_id",
        "key",
        "held_out",
        F.coalesce("guess", F.lit("und")).alias("lang_pred"),
        F.when(F.col("guess").isNotNull(), 1 / F.col("mass")).otherwise(0.0).alias("score"),
        "n",
        "entropy",
        F.coalesce(excess > F.greatest(F.col("limit"), F.lit(1.0)) * MARGIN, F.lit(True)).alias("rejected"),
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    name = free_name(docs, "_row_key")
    verdicts = identify(docs)
    gone = stage(verdicts.where("rejected").select(F.col("key").alias(name)).distinct())
    return dimension_join(docs.withColumn(name, row_key()), gone, name, "left_anti").select(*docs.columns)
