"""Media columns: byte payloads as WAV samples, short-time spectra and spectral-peak pair fingerprints."""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.llm.common import arrow_input, field, written

RATE, UNIT = 8000, 64
FRAME, HOP = 256, 128
SLAB = 8  #: frames a tile spans
BANDS = ((1, 17), (17, 41), (41, 77), (77, 129))  #: bins of a tile, from low to high
FAN_OUT, ZONE = 3, 32  #: partners of an anchor peak, and how many frames ahead they may lie
BLOCK = 4096  #: frames transformed at once, which bounds memory for any length


def wav_bytes(payload: bytes, rate: int = RATE) -> bytes:
    """A mono WAV file with one unsigned 8-bit sample a byte."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def wav_payload(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        if w.getsampwidth() != 1 or w.getnchannels() != 1:
            raise ValueError("one channel of 8-bit samples is read")
        return w.readframes(w.getnframes())


def padded(raw: bytes, unit: int = UNIT) -> bytes:
    """``raw`` with zero bytes up to a positive multiple of ``unit``."""
    return raw + bytes(max(unit, -(-len(raw) // unit) * unit) - len(raw))


def spectral_peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(frame, bin) of the loudest cell of each tile of the spectrogram, in order of time, then band.

    The last frame is completed with silence. A tile of silence has no peak. Equal magnitudes: the earliest cell.
    """
    frames = max(1, -(-max(0, len(samples) - FRAME) // HOP) + 1)
    wave_ = np.zeros((frames - 1) * HOP + FRAME, dtype=np.float32)
    wave_[: len(samples)] = samples.astype(np.float32) - 128
    view = np.lib.stride_tricks.sliding_window_view(wave_, FRAME)[::HOP]
    window = np.hanning(FRAME).astype(np.float32)
    times, bins = [], []
    for at in range(0, frames, BLOCK):
        power = np.abs(np.fft.rfft(view[at : at + BLOCK] * window, axis=1)).astype(np.float32).round(1)
        n = len(power)
        slabs = -(-n // SLAB)
        if n < slabs * SLAB:
            power = np.vstack([power, np.zeros((slabs * SLAB - n, power.shape[1]), np.float32)])
        t, b, on = [], [], []
        for low, high in BANDS:
            tile = power[:, low:high].reshape(slabs, -1)
            cell = tile.argmax(axis=1)
            t.append(at + np.arange(slabs) * SLAB + cell // (high - low))
            b.append(low + cell % (high - low))
            on.append(tile[np.arange(slabs), cell] > 0)
        on = np.array(on).T.ravel()
        times.append(np.array(t).T.ravel()[on])
        bins.append(np.array(b).T.ravel()[on])
    t, b = np.concatenate(times), np.concatenate(bins)
    order = np.lexsort((b, t))
    return t[order], b[order]


def pair_fingerprints(times: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor frame, hash) of each anchor with up to FAN_OUT later peaks; hash = bin, partner's bin, frames between."""
    t, h = [], []
    for k in range(1, FAN_OUT + 1):
        gap = times[k:] - times[:-k]
        near = gap <= ZONE
        t.append(times[:-k][near])
        h.append((bins[:-k] << 16 | bins[k:] << 8 | gap)[near])
    t, h = np.concatenate(t), np.concatenate(h)
    order = np.lexsort((h, t))
    return t[order].astype(np.int32), h[order].astype(np.int32)


def to_wav(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``n_bytes``, ``media``): each text's UTF-8 bytes, padded with zeros, stored as a WAV in a binary column.

    Null texts are empty; an empty text is 64 samples of byte 0. Null ids and repeated rows have a row each; an empty
    table gives an empty result; other columns are not read.
    """
    schema = T.StructType(
        [field(df, id_col), T.StructField("n_bytes", T.LongType(), False), T.StructField("media", T.BinaryType(), False)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                raw = [(t or "").encode() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(x) for x in raw], pa.int64()),
                        pa.array([wav_bytes(padded(x)) for x in raw], pa.binary()),
                    ],
                    names=[id_col, "n_bytes", "media"],
                )

    return arrow_input(df, id_col, text_col).mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what is made of long texts does not pile up."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def wav_features(df: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Read each WAV back: payload size and hashes, the stored form's size and hash, and its time-coded fingerprint.

    Columns: id, ``n_bytes`` (carried), ``payload_bytes``, ``payload_sha256``, ``tail_crc32`` (last 64 bytes),
    ``media_bytes``, ``media_sha256``, ``fp_times`` and ``fp_hashes`` (arrays of equal length, ordered by time).
    A null media column gives nulls in all of them; null ids and repeated rows have a row each; an empty table gives an
    empty result; other columns are not read.
    """
    ints = T.ArrayType(T.IntegerType(), False)
    kinds = {
        "payload_bytes": (T.LongType(), pa.int64()),
        "payload_sha256": (T.StringType(), pa.string()),
        "tail_crc32": (T.LongType(), pa.int64()),
        "media_bytes": (T.LongType(), pa.int64()),
        "media_sha256": (T.StringType(), pa.string()),
        "fp_times": (ints, pa.list_(pa.field("element", pa.int32(), False))),
        "fp_hashes": (ints, pa.list_(pa.field("element", pa.int32(), False))),
    }
    schema = T.StructType(
        [field(df, id_col), T.StructField("n_bytes", T.LongType())] + [T.StructField(k, v[0]) for k, v in kinds.items()]
    )

    def one(media: bytes | None) -> tuple:
        if media is None:
            return (None,) * len(kinds)
        payload = wav_payload(media)
        times, hashes = pair_fingerprints(*spectral_peaks(np.frombuffer(payload, np.uint8)))
        return (
            len(payload),
            hashlib.sha256(payload).hexdigest(),
            zlib.crc32(payload[-UNIT:]),
            len(media),
            hashlib.sha256(media).hexdigest(),
            times,
            hashes,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [one(m) for m in part.column(2).to_pylist()]
                columns = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds.values())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *columns], names=[id_col, "n_bytes", *kinds]
                )

    return arrow_input(df, id_col, "n_bytes", media_col).mapInArrow(run, schema)


def feature_text():
    """The fingerprint as text: ``time:hash`` pairs in order of time, in base 16."""
    return F.array_join(
        F.zip_with("fp_times", "fp_hashes", lambda t, h: F.concat(F.lower(F.hex(t)), F.lit(":"), F.lower(F.hex(h)))), " "
    )


def media_features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the texts as a media column in the shared folder, read it back and tell its features, also as text."""
    stored = written(to_wav(df, id_col, text_col), "media", compression="zstd")
    return wav_features(stored, id_col).withColumn("feature", feature_text())
