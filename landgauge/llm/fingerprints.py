"""Document fingerprints: an invertible Bloom lookup sketch, in SQL functions alone.

A text is cut into paragraphs: at line feeds, and within a line after the
first sentence end past ``LEAST`` code points, so that an insertion moves no
later cut.  Each paragraph, with its number among equal ones, is a 64-bit
digest.  A sketch of size m has three tables of m cells; a digest stands in
one cell of each, and a cell holds the number, the XOR of the digests and the
XOR of their check hashes.  Sketches are linear: subtracting one from another
cancels what two texts share, and peeling cells that hold one digest recovers
the rest.

A text's fingerprint is its sketch at the first size, from one that follows
from its number of paragraphs on, doubling, at which it peels by itself.  So
a fingerprint always tells its digests, and two fingerprints always tell how
alike they are: their difference is taken at twice the larger size, and at
four times the size after each failure.  Digests are rows, grouped by text:
cells are sums, and a round of peeling is one more sum over the cells left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landgauge.llm.common import materialize, table, text_of

#: Code points after which a sentence end cuts, and after which a line without any is cut.
LEAST, MOST = 64, 512
#: Cells of a table for each digest and at least, steps of peeling (a table each), digests of a task.
LOAD, FLOOR, STEPS, TASK_DIGESTS = 0.75, 8, 15, 64_000
#: Documents of one group of neighbours, and the most groups (so that their heads have a bounded size).
GROUP_ROWS, MOST_GROUPS, COARSE, NAMELESS = 512, 65_536, 128, 64

_ENDS = ".!?…。！？"
PARAGRAPH = rf"[^\n]{{{LEAST},{MOST}}}?(?:[{_ENDS}]+[ \t]*\n*|\n+|$(?!\n))|[^\n]{{1,{LEAST - 1}}}(?:\n+|$(?!\n))|\n+|[^\n]{{1,{MOST}}}"


def paragraphs(text: str) -> str:
    """SQL: the hashes of a text's paragraphs, in order; no character is left out."""
    pattern = PARAGRAPH.replace("\\", "\\\\")
    return f"transform(regexp_extract_all({text}, '{pattern}', 0), s -> xxhash64(s))"


def size_of(n: str, doubled: int) -> str:
    """SQL: cells of a table for ``n`` digests, after ``doubled`` failures."""
    return f"bigint(pow(2, ceil(log2({LOAD} * {n} + {FLOOR})) + {doubled}))"


def _check(digest: str) -> str:
    return f"(xxhash64({digest}, 'check') & 4294967295L)"


def _cell(i: str, digest: str, m: str) -> str:
    """SQL: the number of a digest's cell, which tells its table too."""
    return f"(shiftleft(bigint({i}), 40) | (xxhash64({digest}, int({i})) & ({m} - 1L)))"


_TABLES = (0, 1, 2)
_KEYS = ["uid", "sketch", "m", "cell"]


def cells(rows: DataFrame) -> DataFrame:
    """The sum of ``rows`` (uid, sketch, m, cell, n, k, q): one row a cell that is not empty."""
    out = rows.groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.expr("bit_xor(k)").alias("k"), F.expr("bit_xor(q)").alias("q"))
    return out.where("n != 0 OR k != 0 OR q != 0 OR cell < 0")


def inserted(digests: DataFrame) -> DataFrame:
    """Cells of ``digests`` (uid, d, and ``into``: an array of sketch, m and n, which is 1, or -1 where it is taken off)."""
    places = f"array({', '.join(_cell(str(i), 'd', 't.m') for i in _TABLES)})"
    rows = digests.selectExpr("uid", "d", "explode(into) AS t").selectExpr("uid", "t.sketch", "t.m", f"explode({places}) AS cell", "t.n", "d AS k", f"{_check('d')} AS q")
    return cells(rows)


def peeled(sketches: DataFrame, steps: int = STEPS) -> DataFrame:
    """What is left of ``sketches`` after peeling table by table; a row with cell -1 counts what was recovered.

    A digest alone in its cell is taken from its other cells.  Within one
    table no digest is met twice, so each step is one sum.
    """
    for step in range(steps):
        i = _TABLES[step % 3]
        others = [j for j in _TABLES if j != i]
        pure = f"shiftright(cell, 40) = {i} AND abs(n) = 1 AND cell = {_cell(str(i), 'k', 'm')} AND q = {_check('k')}"
        off = ", ".join(f"named_struct('cell', {_cell(str(j), 'k', 'm')}, 'n', -n, 'k', k, 'q', q)" for j in others)
        moved = f"IF({pure}, array({off}, named_struct('cell', -1L, 'n', 1L, 'k', 0L, 'q', 0L)), array(named_struct('cell', cell, 'n', n, 'k', k, 'q', q)))"
        sketches = cells(sketches.selectExpr("uid", "sketch", "m", f"inline({moved})"))
    return sketches


def _grouped(rows: DataFrame) -> DataFrame:
    """``rows`` with ``grp``: groups of bounded size, in the order of doc_id.

    Quantiles cut the ids into coarse groups, equal widths cut those; an id
    that several quantiles fall on has as many coarse groups less one, over
    which a hash of the texts deals its rows; rows without an id come after
    all others, by that hash.
    """
    n, low, high = rows.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    groups = max(1, min(MOST_GROUPS, -(-n // GROUP_ROWS)))
    coarse = min(COARSE, groups)
    fine = -(-groups // coarse)
    if low is None:
        low = high = 0
    inner = rows.agg(F.percentile_approx("doc_id", [i / coarse for i in range(1, coarse)], 10_000)).first()[0] if coarse > 1 else []
    edges = [low, *(inner or []), high]
    bounds = F.array(*(F.lit(int(e)).cast("long") for e in edges))
    among = F.array(*(F.lit(int(e)).cast("long") for e in edges[1:-1])).cast("array<bigint>")
    rows = rows.withColumn("c", F.size(F.filter(among, lambda e: e <= F.col("doc_id")))).withColumn("r", F.size(F.filter(among, lambda e: e == F.col("doc_id"))))
    start, end = F.get(bounds, F.col("c")).cast("double"), F.get(bounds, F.col("c") + 1).cast("double")
    within = F.floor((F.col("doc_id").cast("double") - start) / F.greatest(F.lit(1.0), end - start) * fine).cast("int")
    part = (F.col("h").cast("double") + 2.0**63) / 2.0**64
    spread = F.col("c") * fine - 1 - F.floor(part * (F.col("r") - 1) * fine).cast("int")
    plain = F.col("c") * fine + F.greatest(F.lit(0), F.least(F.lit(fine - 1), within))
    nameless = -1 - coarse * fine - F.floor(part * NAMELESS).cast("int")
    return rows.withColumn("grp", F.when(F.col("doc_id").isNull(), nameless).when(F.col("r") > 1, spread).otherwise(plain)).drop("c", "r")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text: each document with the next one's text.

    The order is that of descending doc_id, rows without an id last, ties by
    a hash of the text; after the last comes the first.  Texts are shuffled
    once, by group; the first document of each group (at most
    ``MOST_GROUPS + NAMELESS`` ids, which are broadcast) also goes to the group
    before.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("h", F.xxhash64("text"))
    rows = _grouped(rows).withColumn("at", F.when(F.col("doc_id").isNull(), F.lit(0).cast("long")).otherwise(F.col("doc_id")))
    heads = rows.groupBy("grp").agg(F.max(F.struct("at", F.bitwise_not("h").alias("reversed"))).alias("head")).select("grp", "head.at", F.bitwise_not("head.reversed").alias("h"))
    down = Window.orderBy(F.desc("grp"))
    last = F.min("grp").over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("grp", "at", "h", F.coalesce(F.lag("grp").over(down), last).alias("also"))
    rows = rows.join(F.broadcast(heads), ["grp", "at", "h"], "left")
    own = F.struct(F.col("grp").alias("g"), F.lit(False).alias("guest"))
    rows = rows.withColumn("to", F.explode(F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("also").alias("g"), F.lit(True).alias("guest"))))))
    rows = rows.select("doc_id", "text", "h", "at", "to.g", "to.guest")
    order = Window.partitionBy("g").orderBy("guest", F.desc("at"), "h")
    return rows.withColumn("next_text", F.lead("text").over(order)).where("not guest").select("doc_id", "text", F.coalesce("next_text", "text").alias("next_text"))


def _prepared(docs: DataFrame) -> DataFrame:
    """One row a document: its id, length, the edited text's hash, and the paragraph hashes of the three texts."""
    rows = with_next(docs).selectExpr("doc_id", "text", "next_text", "bigint(char_length(text)) AS n_chars")
    third = "int(n_chars div 3)"
    rows = rows.selectExpr("*", f"concat(substring(text, 1, int(n_chars) - {third}), substring(next_text, 1, {third})) AS edited")
    rows = rows.selectExpr("doc_id", "n_chars", "sha2(edited, 256) AS edited_sha256", *(f"{paragraphs(t)} AS p_{k}" for k, t in (("own", "text"), ("edit", "edited"), ("next", "next_text"))))
    return materialize(rows.withColumn("uid", F.monotonically_increasing_id()))


#: The texts of a document, and the sketches each goes into (name, 1 or -1 where it is taken off).
_TEXTS = {"own": (("a", 1), ("x", 1), ("y", 1)), "edit": (("b", 1), ("x", -1)), "next": (("y", -1),)}


def _dealt(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` dealt by uid, a bounded number of digests a task: all sums and joins by uid follow that dealing."""
    return rows.repartition(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_DIGESTS)), "uid")


def _digests(rows: DataFrame, sketches: dict[str, str]) -> DataFrame:
    """uid, d, into of each paragraph of ``rows``, for ``sketches`` (name: cells of a table, in SQL)."""
    texts = {k: [s for s in v if s[0] in sketches] for k, v in _TEXTS.items()}
    texts = {k: v for k, v in texts.items() if v}
    rows = rows.selectExpr("uid", *(f"p_{k}" for k in texts), *(f"{m} AS {s}" for s, m in sketches.items()))
    listed = ", ".join(f"transform(p_{k}, e -> named_struct('of', {i}, 'e', e))" for i, k in enumerate(texts))
    one = rows.selectExpr("uid", *sketches, f"inline(concat({listed}))").groupBy("uid", "of", "e", *sketches).agg(F.count("*").alias("copies"))
    each = lambda v: ", ".join(f"named_struct('sketch', '{s}', 'm', {s}, 'n', {n}L)" for s, n in v)
    into = " ".join(f"WHEN {i} THEN array({each(v)})" for i, v in enumerate(texts.values()))
    # Equal paragraphs are numbered, so that each is a digest of its own.
    return one.selectExpr("uid", "e", "of", *sketches, "explode(sequence(1L, copies)) AS copy").selectExpr("uid", "xxhash64(e, copy) AS d", f"CASE of {into} END AS into")


def attempt(rows: DataFrame, total: int) -> DataFrame:
    """uid, and for each sketch what peeling left of it.

    ``a`` and ``b`` are the sketches of a text and its edited text, ``x`` and
    ``y`` the text's less the edited and the next text's.
    """
    first = {k: size_of(f"n_{k}", "0") for k in _TEXTS}
    sizes = {"a": size_of("n_own", "twice_own"), "b": size_of("n_edit", "twice_edit")}
    sizes |= {s: f"shiftleft(2L, 2 * more) * greatest({first['own']}, {first[k]})" for s, k in (("x", "edit"), ("y", "next"))}
    left = peeled(inserted(_digests(_dealt(rows, total), sizes)))
    stuck = [f"count_if(sketch = '{s}' AND cell >= 0) AS {s}_left" for s in "abxy"]
    apart = [f"coalesce(sum(IF(sketch = '{s}' AND cell < 0, n, 0L)), 0L) AS {s}_apart" for s in "xy"]
    return left.groupBy("uid").agg(*map(F.expr, (*stuck, *apart)))


def written(rows: DataFrame) -> DataFrame:
    """uid, a_cells, b_cells: the fingerprints' cells as strings, by table and place.  ``rows`` are dealt by uid."""
    held = inserted(_digests(rows, {"a": size_of("n_own", "twice_own"), "b": size_of("n_edit", "twice_edit")}))
    entry = "concat(lpad(hex(shiftleft(shiftright(cell, 40), 28) | (cell & 268435455L)), 8, '0'), lpad(hex(n), 4, '0'), lpad(hex(k), 16, '0'), lpad(hex(q), 8, '0'))"
    return held.groupBy("uid").agg(*(F.expr(f"array_join(sort_array(collect_list(IF(sketch = '{s}', {entry}, NULL))), '')").alias(f"{s}_cells") for s in "ab"))


def likeness(n_a: str, n_b: str, apart: str) -> str:
    """SQL: shared digests over all of both; texts without any are alike."""
    return f"IF({n_a} + {n_b} = 0, 1D, ({n_a} + {n_b} - {apart}) / double({n_a} + {n_b} + {apart}))"


def fingerprinted(docs: DataFrame) -> DataFrame:
    """The fingerprints of every row, of its edited text, and their likenesses.

    A fingerprint is the number of digests, the size m, and each cell that is
    not empty: its table and place (1 + 7 hexadecimal digits), number (4),
    digests (16) and checks (8).  Null texts count as empty; very long texts
    have larger sketches; a single document is its own next one; null ids
    stay null; repeated rows follow each other; an empty table gives no rows;
    other columns are not read.
    """
    prepared = _prepared(docs).selectExpr("*", *(f"size(p_{k}) AS n_{k}" for k in _TEXTS))
    total = prepared.agg(F.expr("sum(n_own + n_edit + n_next)")).first()[0]
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    if total is None:
        return docs.sparkSession.createDataFrame([], schema)
    state, stuck = ["twice_own", "twice_edit", "more"], [f"{s}_left" for s in "abxy"]
    todo, left, done = prepared.selectExpr("*", *(f"0 AS {s}" for s in state)), total, []
    while left is not None:
        # Documents without any paragraph in their three texts have no cells.
        tried = materialize(todo.select("uid", *state).join(attempt(todo, left), "uid", "left").fillna(0))
        failed = f"{' + '.join(stuck)} > 0"
        done.append(tried.where(f"NOT ({failed})").drop(*stuck))
        again = materialize(tried.where(failed).selectExpr("uid", "twice_own + IF(a_left > 0, 1, 0) AS twice_own", "twice_edit + IF(b_left > 0, 1, 0) AS twice_edit", "more + 1 AS more"))
        todo = materialize(prepared.join(again, "uid"))
        left = todo.agg(F.expr("sum(n_own + n_edit + n_next)")).first()[0]
    settled = done[0]
    for d in done[1:]:
        settled = settled.unionByName(d)
    settled = _dealt(settled, total).hint("merge")
    # Digests and what else is known of a document are dealt apart, once each; the joins move nothing.
    out = _dealt(prepared.drop(*(f"p_{k}" for k in _TEXTS)), total).join(settled, "uid").join(written(_dealt(prepared.drop("doc_id", "n_chars", "edited_sha256", "p_next"), total).join(settled, "uid")).hint("merge"), "uid", "left")
    prints = [f"lower(concat(n_{k}, ':', {size_of(f'n_{k}', f'twice_{k}')}, ':', coalesce({s}_cells, ''))) AS {name}" for k, s, name in (("own", "a", "fingerprint"), ("edit", "b", "edited_fingerprint"))]
    near = [f"{likeness('n_own', f'n_{k}', f'{s}_apart')} AS near_{name}" for k, s, name in (("edit", "x", "edited"), ("next", "y", "next"))]
    return out.selectExpr("doc_id", "n_chars", "edited_sha256", *prints, *near)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(table(spark, sf_dir, "documents"))
