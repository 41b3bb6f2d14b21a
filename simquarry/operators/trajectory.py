"""Frames: fluctuations, deviations, sampling, superposition.

Coordinates are a long table (sim_id, frame, atom_id, x, y, z), so that the
frames of one long trajectory spread over the cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simquarry.functions import fixed_values as fv
from simquarry.operators.ranking import rank_in_group
from simquarry.operators.structure import kept_atoms, select_atoms
from simquarry.session import broadcast_if_small

_XYZ = ("x", "y", "z")
_REF = ("rx", "ry", "rz")
_PAIRS = [(p, r) for p in _XYZ for r in _XYZ]


# --- selections and references ---------------------------------------------
def selected(coords: DataFrame, atoms: DataFrame | None) -> DataFrame:
    """Coordinates of the given atoms; the atom list is narrow."""
    if atoms is None:
        return coords
    return coords.join(broadcast_if_small(atoms.select("sim_id", "atom_id")), ["sim_id", "atom_id"], "left_semi")


def start_frames(coords: DataFrame) -> DataFrame:
    """The least frame of each simulation: (sim_id, frame)."""
    return coords.groupBy("sim_id").agg(F.min("frame").alias("frame"))


def first_frame(
    coords: DataFrame, atoms: DataFrame | None = None, frame: int | None = None, starts: DataFrame | None = None
) -> DataFrame:
    """One frame as a structure, with the columns of ``atoms`` if given.

    It is the frame of that number, whose filter reaches the scan, or the first
    one that each simulation has.  ``starts`` gives those if they are known.
    """
    if frame is not None:
        one = coords.where(F.col("frame") == frame)
    else:
        one = coords.join(broadcast_if_small(start_frames(coords) if starts is None else starts), ["sim_id", "frame"], "left_semi")
    return one if atoms is None else one.join(atoms, ["sim_id", "atom_id"])


# --- RMSF, RMSD ------------------------------------------------------------
def rmsf(coords: DataFrame, atoms: DataFrame | None = None) -> DataFrame:
    """Root of the summed positional variance per atom, without superposition."""
    var = F.var_pop("x") + F.var_pop("y") + F.var_pop("z")
    return selected(coords, atoms).groupBy("sim_id", "atom_id").agg(F.sqrt(var).alias("rmsf"))


def cross_sums(coords: DataFrame, ref: DataFrame) -> DataFrame:
    """Per frame: number of atoms, centroids, centred 3x3 cross sums with the
    reference (r_xx .. r_zz) and centred squared norms.

    ``ref`` has (sim_id, atom_id, x, y, z).  A short reference is broadcast, so
    the coordinates are read once and combined per frame before the shuffle.
    Spark's covariances are centred as they are summed and merged, so frames far
    from the origin lose no digits.
    """
    r = ref.select("sim_id", "atom_id", *[F.col(c).alias(f"r{c}") for c in _XYZ])
    both = coords.join(broadcast_if_small(r), ["sim_id", "atom_id"])
    n = F.count(F.lit(1)).cast("double")
    square = lambda names: sum((n * F.var_pop(c) for c in names[1:]), n * F.var_pop(names[0]))
    return both.groupBy("sim_id", "frame").agg(
        n.alias("n"),
        *[F.avg(c).alias(f"m_{c}") for c in (*_XYZ, *_REF)],
        *[(n * F.covar_pop(p, f"r{q}")).alias(f"r_{p}{q}") for p, q in _PAIRS],
        square(_XYZ).alias("g_p"), square(_REF).alias("g_r"),
    )


def _det(m: list[list[Column]]) -> Column:
    return (
        m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1])
        - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
        + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])
    )


def rmsd(coords: DataFrame, ref_frame: int | None = None, atoms: DataFrame | None = None) -> DataFrame:
    """RMSD of each frame against one of the same simulation after the best
    rigid fit: the frame of that number, or the first.

    The singular values of the cross-sum matrix R come from the eigenvalues of
    the symmetric matrix R'R in closed (trigonometric) form, so everything
    stays in built-in expressions.
    """
    chosen = selected(coords, atoms)
    sums = cross_sums(chosen, first_frame(chosen, frame=ref_frame))
    r = [[F.col(f"r_{p}{q}") for q in _XYZ] for p in _XYZ]
    # Steps are separate projections: each column is computed once.
    s = {
        (i, j): sum((r[k][i] * r[k][j] for k in range(1, 3)), r[0][i] * r[0][j])
        for i in range(3) for j in range(i, 3)
    }
    step = sums.select(
        "sim_id", "frame", "n", "g_p", "g_r", _det(r).alias("det_r"),
        *[v.alias(f"q{i}{j}") for (i, j), v in s.items()],
    )
    q = [[F.col(f"q{min(i, j)}{max(i, j)}") for j in range(3)] for i in range(3)]
    t = (q[0][0] + q[1][1] + q[2][2]) / 3
    step = step.withColumn("t", t)
    spread = sum(((q[i][i] - F.col("t")) ** 2 for i in range(3)), F.lit(0.0)) + 2 * (
        q[0][1] ** 2 + q[0][2] ** 2 + q[1][2] ** 2
    )
    shifted = [[q[i][j] - F.col("t") if i == j else q[i][j] for j in range(3)] for i in range(3)]
    step = step.withColumn("w", F.sqrt(spread / 6)).withColumn("d", _det(shifted))
    arg = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("d") / (2 * F.col("w") ** 3)))
    step = step.withColumn("phi", F.when(F.col("w") == 0, 0.0).otherwise(F.acos(arg) / 3))
    step = step.withColumn("e1", F.col("t") + 2 * F.col("w") * F.cos("phi")).withColumn(
        "e3", F.col("t") + 2 * F.col("w") * F.cos(F.col("phi") + F.lit(2 * np.pi / 3))
    )
    root = lambda c: F.sqrt(F.greatest(c, F.lit(0.0)))
    fit = root(F.col("e1")) + root(3 * F.col("t") - F.col("e1") - F.col("e3")) + F.signum("det_r") * root(F.col("e3"))
    value = root((F.col("g_p") + F.col("g_r") - 2 * fit) / F.col("n"))
    return step.select("sim_id", "frame", value.alias("rmsd"))


def gate(values: DataFrame, sims: DataFrame, limit: float = fv.MAX_RMSD) -> DataFrame:
    """Accept or reject the series (sim_id, value) of each simulation."""
    tops = values.groupBy("sim_id").agg(F.max("value").alias("max_value"))
    reason = F.when(F.col("max_value").isNull(), "no values").when(F.col("max_value") > limit, "above the limit")
    return (
        sims.select("sim_id").distinct().join(tops, "sim_id", "left")
        .withColumn("reason", reason)
        .withColumn("accepted", F.col("reason").isNull())
    )


# --- sampling --------------------------------------------------------------
def stride_sample(df: DataFrame, key: str, order: str, target: int = fv.SERIES_POINTS) -> DataFrame:
    """Every (n div target)-th point of series longer than ``target``."""
    ranked = rank_in_group(df, [key], [order], "__rank", "__n")
    step = F.greatest(F.floor(F.col("__n") / target), F.lit(1))
    keep = (F.col("__n") <= target) | ((F.col("__rank") - 1) % step == 0)
    return ranked.where(keep).drop("__rank", "__n")


def sampled_frames(coords: DataFrame) -> DataFrame:
    """Frames to keep: a stride over the first thousand.

    The rank limit is applied before the shuffle, the count is an aggregate.
    """
    frames = coords.select("sim_id", "frame").distinct()
    counts = frames.groupBy("sim_id").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("sim_id").orderBy("frame"))
    head = frames.withColumn("__rank", rank).where(F.col("__rank") <= fv.SAMPLE_FROM_FRAMES)
    end = F.least("n", F.lit(fv.SAMPLE_FROM_FRAMES))
    stride = F.when(end > fv.SAMPLE_FRAMES, F.floor(end / fv.SAMPLE_FRAMES)).otherwise(1)
    return head.join(counts, "sim_id").where((F.col("__rank") - 1) % stride == 0).select("sim_id", "frame")


def sample_frames(coords: DataFrame) -> DataFrame:
    return coords.join(broadcast_if_small(sampled_frames(coords)), ["sim_id", "frame"], "left_semi")


# --- rigid motions ---------------------------------------------------------
@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _best_rotation(m: pd.Series) -> pd.Series:
    """Rotation (row-major) that best maps centred points onto the reference,
    from their 3x3 cross sums; one batch of frames at a time."""
    if not len(m):
        return pd.Series([], dtype=object)
    u, _s, vt = np.linalg.svd(np.stack(m.to_list()).reshape(-1, 3, 3))
    flip = np.ones((len(m), 3))
    flip[:, 2] = np.sign(np.linalg.det(u @ vt))
    rot = np.swapaxes(vt, 1, 2) @ (flip[:, :, None] * np.swapaxes(u, 1, 2))
    return pd.Series(list(rot.reshape(-1, 9)))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _principal_rotation(m: pd.Series) -> pd.Series:
    """Rotation to the principal axes, longest along x, from 3x3 second
    moments.  Eigenvectors have no sign: the largest component of the first two
    is made positive, the third completes a right-handed frame."""
    if not len(m):
        return pd.Series([], dtype=object)
    _values, vectors = np.linalg.eigh(np.stack(m.to_list()).reshape(-1, 3, 3))
    axes = np.swapaxes(vectors[:, :, ::-1], 1, 2)
    for k in (0, 1):
        lead = np.take_along_axis(axes[:, k], np.abs(axes[:, k]).argmax(1)[:, None], 1)
        axes[:, k] *= np.where(lead < 0, -1.0, 1.0)
    axes[:, 2] = np.cross(axes[:, 0], axes[:, 1])
    return pd.Series(list(axes.reshape(-1, 9)))


def _rotated(rot: Column, point: list[Column], shift: list[Column]) -> list[Column]:
    return [
        (rot[3 * i] * point[0] + rot[3 * i + 1] * point[1] + rot[3 * i + 2] * point[2] + shift[i]).alias(c)
        for i, c in enumerate(_XYZ)
    ]


def superpose(coords: DataFrame, ref: DataFrame, fit: DataFrame | None = None) -> DataFrame:
    """Move every frame onto a reference by the fit atoms.

    Only the fits pass through Python, one row of nine sums per frame.
    """
    sums = cross_sums(selected(coords, fit), ref)
    matrix = F.array(*[F.col(f"r_{p}{q}") for p, q in _PAIRS])
    moves = sums.select("sim_id", "frame", _best_rotation(matrix).alias("rot"), *[f"m_{c}" for c in (*_XYZ, *_REF)])
    point = [F.col(c) - F.col(f"m_{c}") for c in _XYZ]
    shift = [F.col(f"m_r{c}") for c in _XYZ]
    return coords.join(moves, ["sim_id", "frame"]).select(
        "sim_id", "frame", "atom_id", *_rotated(F.col("rot"), point, shift)
    )


def orient_reference(structure: DataFrame, fit: DataFrame | None = None) -> DataFrame:
    """Turn each structure to its principal axes, then 90 degrees about z and
    -90 degrees about x.

    ``structure`` has one frame per simulation.  Rotations are about the
    origin.
    """
    points = selected(structure, fit)
    moments = F.array(*[F.count(F.lit(1)) * F.covar_pop(p, q) for p, q in _PAIRS])
    turns = points.groupBy("sim_id").agg(moments.alias("m")).select("sim_id", _principal_rotation(F.col("m")).alias("rot"))
    zero = [F.lit(0.0)] * 3
    turned = structure.join(turns, "sim_id").select(
        "sim_id", "frame", "atom_id", *_rotated(F.col("rot"), [F.col(c) for c in _XYZ], zero)
    )
    # 90 about z: (x, y, z) -> (-y, x, z); -90 about x: (x, y, z) -> (x, z, -y).
    return turned.select(
        "sim_id", "frame", "atom_id", (-F.col("y")).alias("x"), F.col("z").alias("y"), (-F.col("x")).alias("z")
    )


def minimal(atoms: DataFrame, coords: DataFrame, keep_lipids: bool = False) -> tuple[DataFrame, DataFrame]:
    """Stripped trajectory, fitted to its oriented first frame, and that
    frame after the fit."""
    kept = kept_atoms(atoms, keep_lipids)
    mine = selected(coords, kept)
    fit = select_atoms(kept)
    starts = start_frames(mine)
    fitted = superpose(mine, orient_reference(first_frame(mine, starts=starts), fit), fit)
    return fitted, first_frame(fitted, starts=starts)
