"""Images (S8, M13, M14, A13).

Spark's ``image`` source decodes files in the executors (undecodable files come
with height -1); the quality test runs on the decoded bytes with numpy inside
``mapInPandas``; the resize plan is column arithmetic.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.sources.manifest import IMAGE_EXTENSIONS

# Fixed values that must equal the reference behaviour.
TARGET_SIZE = (256, 256)
MIN_STD = 1.0
IMAGE_BATCH_BYTES = 16 << 20  # decoded images handed to Python at once, unless one alone is larger


#: Formats that the reference reads and Spark's image source can't decode.
UNDECODABLE = (".webp",)
IMAGE_SCHEMA = "path string, height int, width int, channels int, data binary"


def read_images(spark: SparkSession, path: str | None, by_name: bool = True) -> DataFrame:
    """Image files under ``path`` (by extension unless not ``by_name``), invalid ones kept with height -1.

    Without a path, no images.
    """
    if path is None:
        return spark.createDataFrame([], IMAGE_SCHEMA)
    reader = spark.read.format("image").option("dropInvalid", False)
    if by_name:  # either case of every letter: .png and .PNG are the same kind of file
        reader = reader.option("pathGlobFilter", "*.{" + ",".join(
            "".join(f"[{c}{c.upper()}]" for c in e.lstrip(".")) for e in IMAGE_EXTENSIONS) + "}")
    df = reader.load(path)
    return df.select(F.col("image.origin").alias("path"), F.col("image.height").alias("height"),
                     F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"),
                     F.col("image.data").alias("data"))


def _deviation(channel: np.ndarray) -> float:
    """Standard deviation of 8-bit values from their counts: exact, and no array of floats the size of the image."""
    n = np.bincount(channel, minlength=256)
    v = np.arange(256)
    mean = (n * v).sum() / n.sum()
    return float(np.sqrt((n * (v - mean) ** 2).sum() / n.sum()))


def _quality(it, min_std: float):
    for pdf in it:
        out = []
        for path, h, w, c, data in zip(pdf["path"], pdf["height"], pdf["width"], pdf["channels"], pdf["data"]):
            if h is None or h <= 0 or w <= 0 or data is None or len(data) != h * w * c:
                out.append(("undecodable" if (path or "").lower().endswith(UNDECODABLE) else "corrupt", None))
                continue
            px = np.frombuffer(data, dtype=np.uint8).reshape(-1, c)[:, :3]
            std = float(np.mean([_deviation(px[:, i]) for i in range(px.shape[1] if c >= 3 else 1)]))
            out.append(("blank" if std < min_std else "kept", std))
        yield pd.DataFrame({"path": pdf["path"], "height": pdf["height"], "width": pdf["width"],
                            "outcome": [o for o, _ in out], "mean_std": [s for _, s in out]})


def image_quality(images: DataFrame, min_std: float = MIN_STD) -> DataFrame:
    """Outcome per image: corrupt (unreadable), blank (mean RGB std < min_std), undecodable (a format
    without a decoder here: neither removed nor judged) or kept.

    Images go to Python in batches of bounded size, so a task holds few decoded images whatever their sizes.
    """
    images.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(IMAGE_BATCH_BYTES))
    return images.mapInPandas(lambda it: _quality(it, min_std),
                              "path string, height int, width int, outcome string, mean_std double")


def outcome_counts(quality: DataFrame) -> DataFrame:
    """One row: total, kept, removed_corrupt, removed_blank, undecodable."""
    o = F.col("outcome")
    return quality.agg(F.count(F.lit(1)).alias("total"),
                       F.sum((o == "kept").cast("long")).alias("kept"),
                       F.sum((o == "corrupt").cast("long")).alias("removed_corrupt"),
                       F.sum((o == "blank").cast("long")).alias("removed_blank"),
                       F.sum((o == "undecodable").cast("long")).alias("undecodable")).na.fill(0)


def letterbox_plan(df: DataFrame, size=TARGET_SIZE, width: str = "width", height: str = "height",
                   path: str = "path") -> DataFrame:
    """Fit inside ``size`` keeping the aspect ratio, centre with padding.

    new size: the side that limits is the target side; the other is
    round(other / limiting * target) (half-even). Offsets: round(free * 0.5).
    Output: new_width, new_height, pad_left, pad_top, target_name (<stem>.png).
    """
    tw, th = size
    w, h = F.col(width).cast("double"), F.col(height).cast("double")
    im, dest = w / h, F.lit(tw / th)
    nh = F.bround(h / w * tw, 0).cast("int")
    nw = F.bround(w / h * th, 0).cast("int")
    new_w = F.when(im > dest, F.lit(tw)).when(im < dest, nw).otherwise(F.lit(tw))
    new_h = F.when(im > dest, nh).when(im < dest, F.lit(th)).otherwise(F.lit(th))
    pad_left = F.when(new_w != tw, F.bround((tw - new_w) * 0.5, 0)).otherwise(0).cast("int")
    pad_top = F.when((new_w == tw) & (new_h != th), F.bround((th - new_h) * 0.5, 0)).otherwise(0).cast("int")
    name = F.element_at(F.split(F.col(path), "/"), -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return df.select("*", new_w.alias("new_width"), new_h.alias("new_height"), pad_left.alias("pad_left"),
                     pad_top.alias("pad_top"), F.concat(stem, F.lit(".png")).alias("target_name"))
