"""Windowed spectra of sampled signals.

A signal comes as blocks of samples of any length. Blocks are cut along chunks of frames, each chunk taking what
its frames and the frame before them need, so that frames cross block borders and no entity is in one row. A
chunk's frames are transformed at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import ENTITY

#: Samples of a frame and from one frame to the next, samples a second, and frames that a task transforms at once.
FRAME, HOP, RATE, CHUNK = 2048, 512, 44_100.0, 256
#: Sums of magnitudes below this count as this when spectra are scaled.
LEAST_SUM = 1e-8
MEASURES = ["loudness", "spectral_centroid", "spectral_flux", "onset_strength"]


def hann(frame: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(frame) / max(1, frame - 1))


def measures(frames: np.ndarray, rate: float) -> dict[str, np.ndarray]:
    """Loudness (root mean square), centroid of the magnitudes, flux (distance of consecutive scaled magnitudes, 0
    in the first) and onset strength (the larger of flux and loudness) of the rows of a matrix."""
    magnitude = np.abs(np.fft.rfft(frames * hann(frames.shape[1]), axis=1))
    total = magnitude.sum(axis=1)
    frequency = np.fft.rfftfreq(frames.shape[1], 1.0 / rate)
    scaled = magnitude / np.maximum(total, LEAST_SUM)[:, None]
    loudness = np.sqrt((frames**2).mean(axis=1))
    centroid = np.where(total > 0, (magnitude @ frequency) / np.where(total > 0, total, 1.0), 0.0)
    flux = np.concatenate([[0.0], np.linalg.norm(np.diff(scaled, axis=0), axis=1)])
    return {"loudness": loudness, "spectral_centroid": centroid, "spectral_flux": flux, "onset_strength": np.maximum(flux, loudness)}


def frame_measures(blocks: DataFrame, frame: int = FRAME, hop: int = HOP, rate: float = RATE, chunk: int = CHUNK) -> DataFrame:
    """(entity_id, frame_index, time and the measures) of blocks (entity_id, start, samples), start being the place of a
    block's first sample, from 0 without gaps. Frames start every ``hop`` samples; the first that reaches the signal's
    end is the last, zeros standing for what it lacks. Of samples given twice the later block's count."""
    step, start, end = chunk * hop, F.col("start"), F.col("start") + F.size("samples")
    first = F.greatest(F.lit(0), F.floor((start - frame - (chunk - 1) * hop) / step) + 1)
    last = F.floor((end + hop - 1) / step)
    lies = blocks.where(F.size("samples") > 0).select(ENTITY, "start", "samples", F.explode(F.sequence(first, last)).alias("chunk"))
    low, high = F.greatest(F.lit(0), (F.col("chunk") * chunk - 1) * hop), (F.col("chunk") * chunk + chunk - 1) * hop + frame
    at, until = F.greatest(low, start), F.least(high, end)
    cut = lies.where(until > at).select(ENTITY, "chunk", F.struct(at.cast("long").alias("at"), F.slice("samples", (at - start + 1).cast("int"), (until - at).cast("int")).alias("samples")).alias("piece"))
    held = cut.groupBy(ENTITY, "chunk").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    flat = held.select(ENTITY, "chunk", F.transform("pieces", lambda p: p["at"]).alias("at"), F.transform("pieces", lambda p: F.size(p["samples"])).alias("size"), F.flatten(F.transform("pieces", lambda p: p["samples"])).cast("array<double>").alias("samples"))
    kind = flat.schema[ENTITY].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number = batch.column(1)[i].as_py()
                ahead = 1 if number else 0  # the frame before the chunk's, for the flux of its first
                begin = (number * chunk - ahead) * hop
                data = np.zeros((chunk - 1 + ahead) * hop + frame)
                values, places, sizes = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (4, 2, 3))
                until, used = 0, 0
                for place, size in zip(places.tolist(), sizes.tolist()):
                    data[place - begin : place - begin + size] = values[used : used + size]
                    until, used = max(until, place - begin + size), used + size
                # a frame is there if the one before it does not reach the end
                count = min(chunk + ahead, 1 + max(0, -(-(until - frame) // hop)))
                if count <= ahead:
                    continue
                rows = np.lib.stride_tricks.sliding_window_view(data, frame)[::hop][:count]
                found = measures(rows, rate)
                index = np.arange(number * chunk, number * chunk + count - ahead)
                entity = batch.column(0).take(pa.array(np.full(len(index), i)))
                yield pa.RecordBatch.from_arrays([entity, pa.array(index), pa.array(index * hop / rate), *[pa.array(found[m][ahead:]) for m in MEASURES]], names=[ENTITY, "frame_index", "time", *MEASURES])

    return flat.mapInArrow(run, f"{ENTITY} {kind}, frame_index long, time double, {', '.join(f'{m} double' for m in MEASURES)}")


def normalised(frames: DataFrame, columns: list[str] = MEASURES, flat: float = 1e-8) -> DataFrame:
    """frames with each column scaled to its entity's range, 0 where the range is below ``flat``."""
    spans = frames.groupBy(ENTITY).agg(*[F.min(c).alias(f"_l_{c}") for c in columns], *[F.max(c).alias(f"_h_{c}") for c in columns])
    scale = lambda c: F.when(F.col(f"_h_{c}") - F.col(f"_l_{c}") < flat, 0.0).otherwise((F.col(c) - F.col(f"_l_{c}")) / (F.col(f"_h_{c}") - F.col(f"_l_{c}")))
    return frames.join(spans, ENTITY).withColumns({c: scale(c) for c in columns}).select(frames.columns)
