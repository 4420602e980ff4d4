"""How much each of several filters removes, in every order of applying them.

What filters remove together depends only on which of them a document fails, so one
number per document, a bit for each filter it fails, is all that is counted. From these
counts follow the removals of each of the 2 ** n coalitions of filters, and from them:

- a step of an order: the coalition with the filter less the one without it;
- the Shapley value: the coefficients of the linear function that fits the removals of
  all coalitions best, by squares weighted with the Shapley kernel, under the constraint
  that they add up to what all filters remove. The normal equations depend on the number
  of filters alone. They are solved in rationals, once, for every right-hand side: each
  value is a weighted sum of the removals, with exact weights.
"""

from fractions import Fraction
from functools import reduce
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlekit.session import stage

WORD = r"[^\x20\x09-\x0D]+"


def _solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """The solution of `matrix` x = `right`, exactly (Gauss-Jordan)."""
    size = len(matrix)
    rows = [[*matrix[i], *right[i]] for i in range(size)]
    for i in range(size):
        pivot = next(j for j in range(i, size) if rows[j][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [value / rows[i][i] for value in rows[i]]
        for j in range(size):
            if j != i and rows[j][i]:
                factor = rows[j][i]
                rows[j] = [x - factor * y for x, y in zip(rows[j], rows[i])]
    return [row[size:] for row in rows]


def shapley_weights(count: int) -> list[list[Fraction]]:
    """For each of `count` players the weights of v(0), v(1), ..., v(2 ** count - 1), whose sum of
    products is the player's Shapley value. v(0) has to be 0.

    Least squares over the coalitions that are neither empty nor full, with the kernel
    (n - 1) / (C(n, s) s (n - s)) and a multiplier for the constraint sum = v(all).
    """
    coalitions, players = range(1 << count), range(count)
    kernel = [Fraction(0)] * (1 << count)
    for c in coalitions[1:-1]:
        size = c.bit_count()
        kernel[c] = Fraction(count - 1, comb(count, size) * size * (count - size))
    one, none = Fraction(1), Fraction(0)
    matrix, right = [], []
    for i in players:
        matrix.append([sum((kernel[c] for c in coalitions if c >> i & 1 and c >> j & 1), none) for j in players] + [one])
        right.append([kernel[c] if c >> i & 1 else none for c in coalitions])
    matrix.append([one] * count + [none])
    right.append([one if c == coalitions[-1] else none for c in coalitions])
    return _solved(matrix, right)[:count]


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text, by letter: true if it fails. A null text is an empty one."""
    body = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(body, F.lit("[A-Z]")) > 2 * F.length(body),
        "D": body.rlike(r"[#$%&*|]"),
    }


def _bits(failures: list[Column]) -> Column:
    """The number whose bit i says whether the i-th filter fails."""
    bits = [F.when(failure, F.lit(1 << i)).otherwise(F.lit(0)) for i, failure in enumerate(failures)]
    return reduce(Column.__add__, bits, F.lit(0))


def failed_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failed, documents, good, toxic: the numbers of documents, of those with quality 1 and
    of those with toxic 1, by source and by the failed filters A to E (bits 0 to 4).

    E fails for a row whose text a row with a smaller doc_id has, in any part. A null doc_id
    comes after all others; rows that repeat doc_id and text fail E together or not at all. A
    null source is an empty one, a null text too. Of several labels of a doc_id any counts; a
    null doc_id has none. Other columns are not read. An empty table gives an empty result.

    Equal texts are told by SHA-256 (with the length), the only thing that is shuffled of a
    text. Rows are counted by (text, doc_id, part) before a join, and are joined to the first
    of their text by (text, doc_id), so the copies of a text do not meet in one task.
    """
    body = F.coalesce("text", F.lit(""))
    key = F.struct(F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("bytes"))
    judged = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        key.alias("body"),
        _bits(list(text_failures(F.col("text")).values())).alias("failed"),
    )
    rows = stage(judged, "filter-failures").groupBy("body", "doc_id", "part", "failed").agg(F.count("*").alias("rows"))
    first = rows.groupBy("body").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    same = rows["body"].eqNullSafe(first["body"]) & rows["doc_id"].eqNullSafe(first["doc_id"])
    copies = F.when(F.col("first").isNull(), F.lit(16)).otherwise(F.lit(0))
    counted = (
        rows.join(first, same, "left")
        .select(rows["doc_id"], "part", (F.col("failed") + copies).alias("failed"), "rows")
        # Before the labels, as copies of one doc_id need one look-up.
        .groupBy("doc_id", "part", "failed")
        .agg(F.sum("rows").alias("rows"))
    )
    marked = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1)).alias("toxic")
    )
    labelled = counted.filter("doc_id is not null").join(marked.filter("doc_id is not null"), "doc_id", "left")
    nameless = counted.filter("doc_id is null").withColumns({"good": F.lit(None), "toxic": F.lit(None)})
    return (
        labelled.unionByName(nameless)
        .groupBy("part", "failed")
        .agg(
            F.sum("rows").alias("documents"),
            F.coalesce(F.sum(F.col("rows") * F.col("good")), F.lit(0)).alias("good"),
            F.coalesce(F.sum(F.col("rows") * F.col("toxic")), F.lit(0)).alias("toxic"),
        )
    )


def coalition_removals(counts: DataFrame, filters: int) -> DataFrame:
    """part, documents, removed, good, toxic: the last three are arrays with the documents that a
    coalition of filters removes, at the index whose bits are its filters. `counts` is as
    `failed_filters` gives it; it has at most 2 ** filters rows a part."""
    measures = ("documents", "good", "toxic")
    hit = F.col("failed").bitwiseAND(F.col("coalition")) != 0
    sums = [F.coalesce(F.sum(F.when(hit, F.col(name))), F.lit(0)).alias(name) for name in measures]
    tabulated = (
        counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << filters) - 1))))
        .groupBy("part", "coalition")
        .agg(*sums, F.sum("documents").alias("total"))
    )
    rows = F.array_sort(F.collect_list(F.struct("coalition", *measures)))
    return tabulated.groupBy("part").agg(F.max("total").alias("total"), rows.alias("rows")).select(
        "part",
        F.col("total").alias("documents"),
        F.col("rows.documents").alias("removed"),
        F.col("rows.good").alias("good"),
        F.col("rows.toxic").alias("toxic"),
    )


def audit_steps(removals: DataFrame, letters: str) -> DataFrame:
    """For every part, order of the filters and step: what the step's filter does there.

    filter_order, step (from 1) and, as long: kept, removed, redundant (fail the filter, but are
    gone already), unique_fails (fail no other filter), good_lost, toxic_lost, and shapley: what
    the filter removes, summed over all orders. There are as many orders as permutations of
    `letters`, so 7 letters are the most (5040 orders). Zeros are included.
    """
    count = len(letters)
    if len(set(letters)) != count or not 1 <= count <= 7:
        raise ValueError("1 to 7 different letters name the filters")
    full = (1 << count) - 1
    orders = ["".join(order) for order in permutations(letters)]

    def removed(coalition: Column, name: str = "removed") -> Column:
        return F.get(F.col(name), coalition)

    # Over all orders a value is its average times their number: a whole number.
    weights = [[weight * factorial(count) for weight in row] for row in shapley_weights(count)]
    assert all(weight.denominator == 1 for row in weights for weight in row)
    values = F.array(
        *[
            reduce(Column.__add__, [F.lit(int(w)) * removed(F.lit(c)) for c, w in enumerate(row) if w], F.lit(0).cast("long"))
            for row in weights
        ]
    )
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    at = F.instr(F.lit(letters), letter) - 1
    earlier = F.substring(F.col("filter_order"), F.lit(1), F.col("step") - 1)
    before = _bits([F.contains(earlier, F.lit(x)) for x in letters])
    own = F.get(F.lit([1 << i for i in range(count)]), F.col("at"))
    steps = (
        removals.withColumn("values", values)
        .withColumn("filter_order", F.explode(F.lit(orders)))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(count))))
        .withColumns({"at": at, "before": before})
        .withColumn("own", own)
        .withColumn("after", F.col("before") + F.col("own"))
    )
    gone = removed(F.col("after")) - removed(F.col("before"))
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("documents") - removed(F.col("after"))).alias("kept"),
        gone.alias("removed"),
        (removed(F.col("own")) - gone).alias("redundant"),
        (removed(F.lit(full)) - removed(F.lit(full) - F.col("own"))).alias("unique_fails"),
        (removed(F.col("after"), "good") - removed(F.col("before"), "good")).alias("good_lost"),
        (removed(F.col("after"), "toxic") - removed(F.col("before"), "toxic")).alias("toxic_lost"),
        F.get(F.col("values"), F.col("at")).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`audit_steps` of the filters A to E over the documents of each source (see `failed_filters`)."""
    return audit_steps(coalition_removals(failed_filters(docs, labels), 5), "ABCDE")
