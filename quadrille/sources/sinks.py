"""Tables as CSV, fixed-width text, partitioned pixels and LaTeX."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.statistics import rounded

LOG = logging.getLogger("quadrille")


def parked(df: DataFrame) -> DataFrame:
    """``df`` written in the folder that ``spark.checkpoint.dir`` names, and read back: a step that later ones share.

    A session on one machine may leave the folder unset; a cluster must name one that all its machines share.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="quadrille-")
    path = f"{folder.rstrip('/')}/parked-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, digits: int = 6, files: int | None = 1, order: Sequence[str | Column] = ()) -> None:
    """Rows in ``order``, doubles rounded, ``NA`` for null, a header; one file for reports, Spark's own number with ``files=None``."""
    out = rounded(df, digits)
    out = out.orderBy(*order) if order else out
    out = out.coalesce(files) if files else out
    out.write.mode("overwrite").options(header=True, nullValue="NA", emptyValue="").csv(path)


def write_pixels(df: DataFrame, path: str) -> bool:
    """Pixel tables by year and month; an empty table is not written."""
    if df.isEmpty():
        LOG.warning("no pixels for %s", path)
        return False
    df.write.mode("overwrite").partitionBy("ano", "mes").parquet(path)
    return True


#: Most rows of a table that is laid out on the driver.
MOST = 100_000


def _few(df: DataFrame, digits: int) -> list:
    rows = rounded(df, digits).limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"a report of more than {MOST} rows: write it as a table")
    return rows


def text_lines(df: DataFrame, title: str, digits: int = 4) -> list[str]:
    """A report of a few rows in columns as wide as their values."""
    rows = _few(df, digits)
    cells = [[("NA" if v is None else str(v)) for v in r] for r in rows]
    widths = [max([len(c), *(len(r[i]) for r in cells)]) for i, c in enumerate(df.columns)]
    line = lambda values: "  ".join(v.rjust(w) for v, w in zip(values, widths, strict=True))
    return [title, "=" * len(title), "", line(df.columns), *map(line, cells)]


def write_lines(spark: SparkSession, lines: list[str], path: str) -> None:
    """A text of a few lines, in one file."""
    spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string").coalesce(1).sortWithinPartitions("i").select("value").write.mode("overwrite").text(path)


def fixed_width(df: DataFrame, columns: dict[str, str], order: list[str], head: list[str], path: str) -> None:
    """A report in columns of fixed width, made where the rows are; ``columns`` gives each its format, null is NA."""
    wide = lambda f: int("".join(x for x in f.split(".")[0] if x.isdigit()))
    cells = [F.coalesce(F.when(F.col(c).isNotNull(), F.format_string(f, c)), F.lit(("%-*s" if "-" in f else "%*s") % (wide(f), "NA"))) for c, f in columns.items()]
    body = df.select(F.lit(1).alias("part"), F.row_number().over(Window.orderBy(*order)).alias("i"), F.concat_ws(" ", *cells).alias("value"))
    title = df.sparkSession.createDataFrame([(0, i, x) for i, x in enumerate(head)], "part int, i int, value string")
    title.unionByName(body).coalesce(1).sortWithinPartitions("part", "i").select("value").write.mode("overwrite").text(path)


def write_text(df: DataFrame, path: str, title: str, digits: int = 4) -> None:
    write_lines(df.sparkSession, text_lines(df, title, digits), path)


def latex(df: DataFrame, caption: str, label: str, digits: int = 3) -> str:
    """A table of a few rows; null is a dash."""
    mask = str.maketrans({c: "\\" + c for c in "_%&#$"})
    rows = [" & ".join("--" if v is None else str(v).translate(mask) for v in r) + r" \\" for r in _few(df, digits)]
    head = " & ".join(c.translate(mask) for c in df.columns) + r" \\"
    body = "\n".join([r"\toprule", head, r"\midrule", *rows, r"\bottomrule"])
    return f"\\begin{{table}}\n\\caption{{{caption}}}\n\\label{{{label}}}\n\\begin{{tabular}}{{{'l' * len(df.columns)}}}\n{body}\n\\end{{tabular}}\n\\end{{table}}\n"


def run_summary(stats: DataFrame) -> DataFrame:
    """Scenes, dates and overall means of a run."""
    return stats.agg(F.count("*").alias("n_scenes"), F.min("data_aq").alias("first"), F.max("data_aq").alias("last"), F.avg("ndvi_media").alias("ndvi"), F.avg("lst_c_media").alias("lst_c"))
