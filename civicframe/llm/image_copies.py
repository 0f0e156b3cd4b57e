"""Copies of images, cropped, resized, turned or edited, by local descriptors.

Corners are found at five scales, each gets an orientation from the intensity centroid of its disc, and a 256-bit
descriptor of brightness comparisons in the smoothed disc, turned by that orientation. Descriptors are put into TABLES
Hamming tables; a key is KEY_BITS of a corner's descriptor with those of two of its NEAR nearest corners of its scale, and
where these lie and how they are turned as seen from it, in sectors and octaves: the same in any turned, resized or
cropped copy. A corner has a key for each two neighbours in each table, of which one that an edit leaves is enough, since
images that share a key are candidates. These are verified on their whole descriptor sets: matches within DISTANCE bits
must agree on one scale, rotation and shift. Images with equal pixels are one class and only its first image is
compared. Long lists of a table go through pivots (``linking``).

An image is a row (image_id long, width int, height int, pixels binary): one byte of grey a pixel, by rows. Corners are
compared in blocks, so memory follows their number, not its square.

Defined cases: null or ill-sized pixels, and images without corners, are linked only with equal images (null: with
nothing); of rows that repeat an id with other pixels the one with the smallest hash counts, readable ones first; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import bound_arrow_batches, broadcast_if_small, mix, written
from civicframe.llm.linking import link_members

#: Pyramid, radius of a disc, smoothing before comparisons, differing bits of a match, matches that agree, pixels of tolerance, longest list with pairs.
SCALES, RADIUS, SMOOTH, DISTANCE, AGREE, PIXELS, SHORT = tuple(2.0 ** (-k / 4) for k in range(5)), 9, 3, 32, 12, 3.0, 6
#: Tables, bits of a descriptor in a key, neighbours of a corner, sectors of a turn, parts of an octave.
TABLES, KEY_BITS, NEAR, SECTORS, OCTAVE = 4, 20, 3, 16, 2.0
#: Part of an image's strongest corner response that counts as a corner.
STRENGTH = 0.03
#: Entries of a block of corners x corners.
BLOCK = 1 << 21


def _pattern() -> np.ndarray:
    """256 pairs of points in the disc, from a fixed seed."""
    r = np.random.default_rng(20)
    points = r.normal(0, RADIUS / 2.2, (4096, 2))
    points = points[np.hypot(*points.T) <= RADIUS][:512]
    return points.reshape(256, 2, 2)


PATTERN = _pattern()


def _resize(n: int, m: int) -> np.ndarray:
    """m x n matrix of bilinear interpolation."""
    at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
    low = np.minimum(at.astype(int), max(n - 2, 0))
    out = np.zeros((m, n), np.float32)
    out[np.arange(m), low] = 1 - (at - low)
    out[np.arange(m), np.minimum(low + 1, n - 1)] += (at - low).astype(np.float32)
    return out


def _blur(x: np.ndarray, r: int) -> np.ndarray:
    """Box mean of radius r over the last two axes."""
    for axis in (-2, -1):
        pad = [(0, 0)] * x.ndim
        pad[axis] = (r + 1, r)
        s = np.cumsum(np.pad(x, pad, mode="edge"), axis=axis, dtype=np.float64)
        n = x.shape[axis]
        hi, lo = [slice(None)] * x.ndim, [slice(None)] * x.ndim
        hi[axis], lo[axis] = slice(2 * r + 1, 2 * r + 1 + n), slice(0, n)
        x = ((s[tuple(hi)] - s[tuple(lo)]) / (2 * r + 1)).astype(np.float32)
    return x


def _largest(x: np.ndarray, r: int) -> np.ndarray:
    for axis in (1, 2):
        y = x
        for d in range(1, r + 1):
            for a, b in ((slice(d, None), slice(None, -d)), (slice(None, -d), slice(d, None))):
                at, of = [slice(None)] * 3, [slice(None)] * 3
                at[axis], of[axis] = a, b
                z = y.copy() if y is x else y
                z[tuple(at)] = np.maximum(z[tuple(at)], x[tuple(of)])
                y = z
        x = y
    return x


def describe(images: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(image, [x, y, scale, angle], 32 bytes) of the corners of a stack of images of one size."""
    owners, places, bits = [], [], []
    n, h, w = images.shape
    images = images.astype(np.float32)
    edge = RADIUS + 2
    for scale in SCALES:
        hh, ww = round(h * scale), round(w * scale)
        if min(hh, ww) <= 2 * edge:
            continue
        x = images if scale == 1 else _resize(h, hh) @ images @ _resize(w, ww).T
        smooth = _blur(x, 1)
        gy, gx = np.gradient(smooth, axis=(1, 2))
        a, b, c = _blur(gx * gx, 2), _blur(gx * gy, 2), _blur(gy * gy, 2)
        corner = a * c - b * b - 0.05 * (a + c) ** 2
        inner = corner[:, edge:-edge, edge:-edge]
        top = inner.max(axis=(1, 2))
        best = _largest(corner.copy(), 2)
        hit = (inner >= best[:, edge:-edge, edge:-edge]) & (inner > STRENGTH * top[:, None, None]) & (top > 1e-3)[:, None, None]
        k, yy, xx = np.nonzero(hit)
        if not len(k):
            continue
        yy, xx = yy + edge, xx + edge
        smooth = _blur(x, SMOOTH)
        d = np.arange(-RADIUS, RADIUS + 1)
        disc = d[:, None] ** 2 + d[None, :] ** 2 <= RADIUS**2
        dy, dx = (v[disc] for v in np.meshgrid(d, d, indexing="ij"))
        for at in range(0, len(k), 4096):
            kk, yk, xk = k[at : at + 4096], yy[at : at + 4096], xx[at : at + 4096]
            patch = smooth[kk[:, None], yk[:, None] + dy, xk[:, None] + dx]
            angle = np.arctan2(patch @ dy.astype(np.float32), patch @ dx.astype(np.float32))
            turn = np.stack([np.stack([np.cos(angle), -np.sin(angle)], -1), np.stack([np.sin(angle), np.cos(angle)], -1)], -2)
            points = np.rint(np.einsum("kij,ptj->kpti", turn, PATTERN)).astype(int)  # x, y
            value = smooth[kk[:, None, None], yk[:, None, None] + points[..., 1], xk[:, None, None] + points[..., 0]]
            bits.append(np.packbits(value[..., 0] < value[..., 1], axis=-1))
            owners.append(kk)
            places.append(np.stack([(xk + 0.5) / scale, (yk + 0.5) / scale, np.full(len(kk), 1 / scale), angle], -1))
    if not owners:
        return np.zeros(0, int), np.zeros((0, 4)), np.zeros((0, 32), np.uint8)
    return np.concatenate(owners), np.concatenate(places), np.concatenate(bits)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, ws, hs, pixels = (batch.column(i).to_pylist() for i in range(4))
        by: dict[tuple[int, int], list[int]] = {}
        for r, (w, h, p) in enumerate(zip(ws, hs, pixels, strict=True)):
            if p is not None and w and h and w > 0 and len(p) == w * h:
                by.setdefault((h, w), []).append(r)
        for (h, w), rows in sorted(by.items()):
            step = max(1, (1 << 19) // (h * w))
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                owner, place, bits = describe(np.stack([np.frombuffer(pixels[r], np.uint8).reshape(h, w) for r in some]))
                order = np.argsort(owner, kind="stable")
                cut = np.searchsorted(owner[order], np.arange(len(some) + 1))
                sets = [(place[order[a:b]].astype(np.float32).tobytes(), bits[order[a:b]].tobytes(), int(b - a)) for a, b in zip(cut, cut[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array([ids[r] for r in some], pa.int64()), pa.array([x for x, _, _ in sets], pa.binary()), pa.array([x for _, x, _ in sets], pa.binary()), pa.array([x for _, _, x in sets], pa.int64())], ["id", "places", "bits", "n"])


def _nearest(places: np.ndarray) -> np.ndarray:
    """Up to NEAR corners of its scale that are nearest to each corner, -1 for none, in blocks; those too close to see anything else don't count."""
    near = np.full((len(places), NEAR), -1)
    for scale in np.unique(places[:, 2]):
        own = np.flatnonzero(places[:, 2] == scale)
        k = min(NEAR, len(own) - 1)
        if k < 2:
            continue
        xy = places[own, :2].astype(np.float32)
        step = max(1, BLOCK // len(own))
        for at in range(0, len(own), step):
            gap = np.square(xy[at : at + step, None] - xy[None]).sum(-1)
            gap[gap < (2.5 * scale) ** 2] = np.inf
            order = np.argpartition(gap, k - 1, axis=1)[:, :k]
            gap = np.take_along_axis(gap, order, 1)
            place = np.argsort(gap, axis=1, kind="stable")
            order, gap = np.take_along_axis(order, place, 1), np.take_along_axis(gap, place, 1)
            near[own[at : at + step], :k] = np.where(np.isfinite(gap), own[order], -1)
    return near


def tokens_of(places: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Distinct keys of an image in all tables: bits of a corner with those of two of its nearest corners, and how they lie."""
    n = len(places)
    if n < 3:
        return np.zeros(0, np.int64)
    near = _nearest(places)
    xy, scale, angle = places[:, :2], places[:, 2], places[:, 3]
    sector = lambda x: np.floor(x * (SECTORS / (2 * np.pi))).astype(np.int64) % SECTORS
    words = np.unpackbits(bits, axis=1).reshape(n, TABLES, -1)[:, :, :KEY_BITS] @ (1 << np.arange(KEY_BITS, dtype=np.int64))
    parts = mix(words.astype(np.uint64) + (np.arange(1, TABLES + 1, dtype=np.uint64) << np.uint64(40)))
    beside = []
    for b in near.T:
        d = xy[b] - xy
        octave = np.floor(np.log2(np.maximum(np.hypot(d[:, 0], d[:, 1]), 1e-3) / scale) * OCTAVE).astype(np.int64)
        lies = (sector(np.arctan2(d[:, 1], d[:, 0]) - angle) * SECTORS + sector(angle[b] - angle)) * 1024 + octave + 512
        beside.append(mix(parts[b] ^ mix(lies.astype(np.uint64))[:, None]))
    keys = [np.zeros(0, np.uint64)]
    for i in range(NEAR):
        for j in range(i):
            both = (near[:, i] >= 0) & (near[:, j] >= 0)
            keys.append(mix(parts * np.uint64(3) + beside[i] + beside[j])[both].ravel())
    return np.unique(np.concatenate(keys)).view(np.int64)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(table and part, image) for every key of an image."""
    for batch in batches:
        tokens, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, place, raw in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            keys = tokens_of(np.frombuffer(place, np.float32).reshape(-1, 4), np.frombuffer(raw, np.uint8).reshape(-1, 32))
            tokens.append(keys)
            ids.append(np.full(len(keys), i, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(ids))], ["token", "id"])


def agree(places_a: np.ndarray, bits_a: np.ndarray, places_b: np.ndarray, bits_b: np.ndarray) -> int:
    """Most matches that agree on one scale, rotation and shift from a to b."""
    a, b = np.ascontiguousarray(bits_a).view(np.uint64), np.ascontiguousarray(bits_b).view(np.uint64)
    if not len(a) or not len(b):
        return 0
    to_b, gap_b = np.zeros(len(a), int), np.zeros(len(a), int)
    to_a, gap_a = np.zeros(len(b), int), np.full(len(b), 257)
    step = max(1, BLOCK // (4 * len(b)))
    for at in range(0, len(a), step):
        distance = np.bitwise_count(a[at : at + step, None, :] ^ b[None, :, :]).sum(-1, dtype=np.int16)
        to_b[at : at + step] = j = distance.argmin(1)
        gap_b[at : at + step] = distance[np.arange(len(j)), j]
        i = distance.argmin(0)
        least = distance[i, np.arange(len(b))]
        closer = least < gap_a
        to_a[closer], gap_a[closer] = i[closer] + at, least[closer]
    i = np.flatnonzero((gap_b <= DISTANCE) & (to_a[to_b] == np.arange(len(a))))  # each other's nearest
    j = to_b[i]
    if len(i) < AGREE:
        return len(i)
    p, q = places_a[i], places_b[j]
    scale, turn = q[:, 2] / p[:, 2], q[:, 3] - p[:, 3]
    x, y = scale * np.cos(turn), scale * np.sin(turn)
    best, step = 0, max(1, BLOCK // (4 * len(i)))
    for at in range(0, len(i), step):
        some = slice(at, at + step)
        # where each hypothesis (a match) puts all corners of the matches
        dx, dy = p[None, :, 0] - p[some, None, 0], p[None, :, 1] - p[some, None, 1]
        px = q[some, None, 0] + x[some, None] * dx - y[some, None] * dy
        py = q[some, None, 1] + y[some, None] * dx + x[some, None] * dy
        reach = PIXELS * np.maximum(1, np.hypot(dx, dy) * scale[some, None] / 40)
        best = max(best, int((np.hypot(px - q[None, :, 0], py - q[None, :, 1]) <= reach).sum(1).max()))
    return best


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(6)]
        keep = []
        for _, _, pa_, ba, pb, bb in zip(*cols, strict=True):
            keep.append(agree(*(np.frombuffer(x, t).reshape(-1, k) for x, t, k in ((pa_, np.float32, 4), (ba, np.uint8, 32), (pb, np.float32, 4), (bb, np.uint8, 32)))) >= AGREE)
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in range(2)], ["a", "b"])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (token, id) -> pairs of lists up to SHORT (a, b), members of longer ones (token, id, the list's first id); a list of one gives nothing."""
    names = ["token", "a", "b"]

    def emit(token: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(token):
            return
        at = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        size = np.diff(np.append(at, len(token)))
        first = np.repeat(ids[at], size)
        size = np.repeat(size, size)
        for gap in range(1, SHORT):
            i = np.flatnonzero((token[gap:] == token[:-gap]) & (size[gap:] <= SHORT))
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.nulls(len(i), pa.int64()), pa.array(ids[i]), pa.array(ids[i + gap])], names)
        i = np.flatnonzero(size > SHORT)
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(token[i]), pa.array(ids[i]), pa.array(first[i])], names)

    open_: list[tuple[np.ndarray, np.ndarray]] = []  # the last token's rows, which may go on
    for batch in batches:
        token, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        if not len(token):
            continue
        if token[0] == token[-1] and open_ and open_[0][0][0] == token[0]:
            open_.append((token, ids))
            continue
        token, ids = (np.concatenate([*(x[k] for x in open_), y]) for k, y in enumerate((token, ids)))
        cut = int(np.count_nonzero(token != token[-1]))
        yield from emit(token[:cut], ids[:cut])
        open_ = [(token[cut:], ids[cut:])]
    if open_:
        yield from emit(*(np.concatenate(x) for x in zip(*open_, strict=True)))


def copies(images: DataFrame) -> DataFrame:
    """One row per image: image_id, n_corners, component_id (the smallest image_id among its copies, copies of those, and so on)."""
    bound_arrow_batches(images.sparkSession)
    content = F.sha2(F.concat(F.encode(F.concat_ws("x", "width", "height"), "utf-8"), F.col("pixels")), 256)
    images = images.where("image_id is not null").select(F.col("image_id").cast("long").alias("id"), "width", "height", "pixels", F.when(F.col("pixels").isNotNull(), content).alias("content"))
    rows = written(images.select("id", "content"), "image-contents")
    wanted = written(rows.groupBy("id").agg(F.count("*").alias("rows"), F.min("content").alias("wanted")), "image-ids")
    several = wanted.where("rows > 1").select("id", "wanted")
    if not several.isEmpty():
        images = images.join(broadcast_if_small(several), "id", "left").where("wanted is null or content = wanted").dropDuplicates(["id"]).drop("wanted")
    rows = wanted.select("id", F.col("wanted").alias("content"))
    first = rows.where("content is not null").groupBy("content").agg(F.min("id").alias("first"))
    rows = written(rows.join(first, "content", "left").select("id", F.coalesce("first", "id").alias("first")), "image-classes")
    ones = images.join(rows.where("id = first").select("id"), "id", "left_semi").select("id", "width", "height", "pixels")
    sets = written(ones.mapInArrow(_sets, "id long, places binary, bits binary, n long"), "image-corners")
    members = sets.where(F.col("n") >= AGREE).select("id", "places", "bits").mapInArrow(_parts, "token long, id long")
    lists = written(members.repartition("token").sortWithinPartitions("token", "id").mapInArrow(_lists, "token long, a long, b long"), "image-lists")
    pairs = written(lists.where("token is null").select("a", "b").distinct(), "image-pairs")
    long = written(lists.where("token is not null").select("token", F.col("a").alias("id"), F.col("b").alias("first")), "image-long")

    def verified(some: DataFrame) -> DataFrame:
        left = some.join(sets.select(F.col("id").alias("a"), F.col("places").alias("pa"), F.col("bits").alias("ba")), "a")
        both = left.join(sets.select(F.col("id").alias("b"), F.col("places").alias("pb"), F.col("bits").alias("bb")), "b")
        return written(both.select("a", "b", "pa", "ba", "pb", "bb").mapInArrow(_verify, "a long, b long"), "image-links")

    labels = link_members(pairs, long, verified).select(F.col("node").alias("first"), "label")
    out = rows.join(labels, "first", "left").join(sets.select(F.col("id").alias("first"), "n"), "first", "left")
    return out.select(F.col("id").alias("image_id"), F.coalesce("n", F.lit(0).cast("long")).alias("n_corners"), F.coalesce("label", "first").alias("component_id"))


def thumbnails(vectors: DataFrame, side: int = 80) -> DataFrame:
    """Grey pictures of vectors of 64 numbers: an 8 x 8 field, drawn smoothly; others have no pixels. The tables here hold no pictures of their own."""
    bound_arrow_batches(vectors.sparkSession)
    grid = _resize(8, side)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out: list[bytes | None] = []
                for v in part.column(1).to_pylist():
                    x = np.array([np.nan if y is None else y for y in v or []], np.float32)
                    if len(x) != 64 or not np.isfinite(x).all():
                        out.append(None)
                        continue
                    low, high = float(x.min()), float(x.max())
                    x = (x - low) / max(high - low, 1e-9) * 255
                    out.append((grid @ x.reshape(8, 8) @ grid.T).clip(0, 255).astype(np.uint8).tobytes())
                sides = pa.array([side] * len(out), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), sides, sides, pa.array(out, pa.binary())], ["image_id", "width", "height", "pixels"])

    return vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("image_id"), "embedding").mapInArrow(draw, "image_id long, width int, height int, pixels binary")
