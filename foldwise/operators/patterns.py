"""Boolean patterns and Hopfield memories.

Images are ``(row_id, pixels ARRAY<...>, h, w)`` in row-major order.  Only
the weight matrix (m x m, m = pixels per image) ever reaches the driver;
recall runs per Arrow batch with that matrix captured in the task closure.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.neighbors_shared import stack_vectors
from foldwise.operators.sequence import seq_by_hash


def image_stack(df: DataFrame, pixels: str = "pixels", h: str = "h", w: str = "w") -> DataFrame:
    """Rows must share one (h, w) and have h*w pixels; checked lazily
    by a run-time error, so the table stays distributed."""
    shapes = df.select(F.col(h), F.col(w)).distinct()
    bad = F.raise_error(F.lit("image_stack: images of different sizes"))
    n_shapes = shapes.agg(F.count(F.lit(1)).alias("_ns"))
    out = df.withColumn("_k", F.lit(1)).join(F.broadcast(n_shapes.withColumn("_k", F.lit(1))), "_k")
    return out.withColumn(pixels, F.when((F.col("_ns") == 1) & (F.size(pixels) == F.col(h) * F.col(w)),
                                         F.col(pixels)).otherwise(bad)).drop("_k", "_ns")


def block_counts(df: DataFrame, width: int, block: int, pixels: str = "pixels", id_col: str = "row_id") -> DataFrame:
    """Set pixels per block x block tile of a width x width bitmap,
    long form ``(row_id, by, bx, n)``."""
    e = df.select(id_col, F.posexplode(pixels).alias("pos", "p"))
    by = (F.floor(F.col("pos") / width) / block).cast("int")
    bx = (F.pmod(F.col("pos"), F.lit(width)) / block).cast("int")
    return e.groupBy(id_col, by.alias("by"), bx.alias("bx")).agg(F.count_if(F.col("p")).alias("n"))


def random_patterns(ids: DataFrame, n_pixels: int, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """One random Boolean pattern per id, each pixel true with p = 1/2:
    parity of the first hex digit of md5('<seed>:<id>:<i>') (reproducible)."""
    bits = F.transform(F.sequence(F.lit(0), F.lit(n_pixels - 1)), lambda i: F.pmod(F.conv(F.substring(
        F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"), F.lit(":"), i.cast("string"))), 1, 1),
        16, 10).cast("int"), F.lit(2)) == 0)
    return ids.select(id_col, bits.alias("pixels"))


def add_noise(df: DataFrame, ratio: float, seed: int = 42, pixels: str = "pixels", id_col: str = "row_id") -> DataFrame:
    """Flip exactly round(total_pixels * ratio) pixels chosen over the
    whole set: pixels ranked by md5('<seed>:<row>:<pos>') (bucketed global
    numbering), the first n flip; images are re-assembled per row."""
    e = df.select(id_col, F.posexplode(pixels).alias("pos", "p"))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"), F.lit(":"), F.col("pos").cast("string")))
    e = e.withColumn("_pid", F.concat_ws(":", F.col(id_col).cast("string"), F.col("pos").cast("string")))
    ranked = seq_by_hash(e, key, "_pid", name="_r", total="_n")
    n_flip = F.bround(F.col("_n") * F.lit(float(ratio)), 0)
    flipped = ranked.withColumn("p", F.when(F.col("_r") < n_flip, ~F.col("p")).otherwise(F.col("p")))
    back = flipped.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", "p"))).alias("_px"))
    return back.select(id_col, F.transform("_px", lambda s: s["p"]).alias(pixels))


def exact_match(images: DataFrame, templates: DataFrame, pixels: str = "pixels", id_col: str = "row_id",
                label: str = "label", template_no: str = "template_no") -> DataFrame:
    """C4: label of the template equal in all pixels (last template wins);
    -1 when none matches.  Equi-join on the pixel array."""
    t = templates.select(F.col(pixels).alias("_px"), label, template_no)
    best = t.groupBy("_px").agg(F.max_by(label, template_no).alias("_lab"))
    j = images.select(id_col, F.col(pixels).alias("_px")).join(best, "_px", "left")
    none = F.lit(-1).cast(templates.schema[label].dataType)
    return j.select(id_col, F.coalesce(F.col("_lab"), none).alias("predicted"))


def hopfield_weights_matrix(w_long: DataFrame, m: int) -> np.ndarray:
    w = np.zeros((m, m), dtype=np.float32)
    for r in w_long.collect():
        w[r["i"], r["j"]] = r["w"]
    return w


def hopfield_recall(df: DataFrame, weights: np.ndarray, pixels: str = "pixels", id_col: str = "row_id",
                    boolean: bool = True, max_steps: int = 1000) -> DataFrame:
    """M8: S <- sign(W S) until a fixed point or a 2-cycle (cap
    ``max_steps``); Boolean patterns map to +-1 and back with >= 0."""
    wmat = weights
    itype = df.schema[id_col].dataType.simpleString()
    out_t = "array<boolean>" if boolean else "array<double>"

    def run(it):
        for pdf in it:
            if len(pdf) == 0:
                continue
            s = stack_vectors(pdf[pixels])
            if boolean:
                s = np.where(s > 0.5, 1.0, -1.0)
            prev = prev2 = None
            done = np.zeros(len(s), dtype=bool)
            steps = np.zeros(len(s), dtype=np.int64)
            for _ in range(max_steps):
                nxt = np.sign(s @ wmat.T)
                if boolean:
                    nxt = np.where(nxt >= 0, 1.0, -1.0)
                same = np.all(nxt == s, axis=1)
                cyc = np.all(nxt == prev2, axis=1) if prev2 is not None else np.zeros(len(s), dtype=bool)
                prev2, prev = s, nxt
                upd = ~done
                steps[upd] += 1
                s = np.where(upd[:, None], nxt, s)
                done |= same | cyc
                if done.all():
                    break
            vals = [list(r >= 0) for r in s] if boolean else [list(r) for r in s]
            yield pd.DataFrame({id_col: pdf[id_col], pixels: vals, "steps": steps})

    return df.select(id_col, pixels).mapInPandas(run, f"{id_col} {itype}, {pixels} {out_t}, steps long")


def pattern_accuracy(train: DataFrame, test: DataFrame, threshold: float, d: int,
                     pixels: str = "pixels", label: str = "label", id_col: str = "row_id") -> DataFrame:
    """M9: per-label mean templates -> binarise -> Hopfield weights from the
    templates -> recall train and test images -> exact match against the
    templates -> accuracy per split."""
    from foldwise.operators.stats import hebbian_weights, mean_template
    tm = mean_template(train.select(label, F.col(pixels).alias("features")), "features", label)
    tmpl = (tm.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("pos", "mean"))).alias("_m"))
            .select(label, F.transform("_m", lambda s: s["mean"] >= threshold).alias(pixels)))
    # one row per class: the window spans the (small) template table only
    tmpl = tmpl.withColumn("template_no", F.dense_rank().over(Window.orderBy(label)))
    w = hopfield_weights_matrix(hebbian_weights(
        tmpl.select(F.transform(pixels, lambda b: F.when(b, 1.0).otherwise(-1.0)).alias("features")),
        d, boolean=True), d)
    out = None
    for name, part in [("train", train), ("test", test)]:
        b = part.select(id_col, label, F.transform(pixels, lambda x: F.when(x >= threshold, 1.0).otherwise(0.0)).alias(pixels))
        rec = hopfield_recall(b, w, pixels, id_col, boolean=True)
        m = exact_match(rec, tmpl, pixels, id_col, label)
        acc = (m.join(part.select(id_col, label), id_col)
               .agg(F.avg((F.col("predicted") == F.col(label)).cast("double")).alias("accuracy"))
               .select(F.lit(name).alias("split"), "accuracy"))
        out = acc if out is None else out.unionByName(acc)
    return out
