"""Media columns: WAV payloads, short-time Fourier transforms, spectral-peak pair fingerprints.

A text's UTF-8 bytes, padded with 255 up to a positive multiple of the frame length, are stored as
8-bit mono samples by the wave module and read back by it. The samples' windows are transformed,
the strongest local peaks of each window are kept, and each peak is paired with peaks of the next
few windows. A fingerprint is one long: window time, then both frequencies and the distance, so
that the array is sorted by time.

Defined cases: a null or empty text is one frame of 255s; equal texts give equal values (magnitudes
are rounded before peaks are chosen, ties go to the lower bin); very long texts are transformed in
runs of windows; repeated rows give repeated rows; an empty table gives none; extra columns of the
input are ignored; a null id stays null.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, text_bytes

FRAME, HOP, PEAKS, REACH, RATE, TAIL = 576, 288, 3, 3, 8000, 32
_WINDOW = np.hanning(FRAME)


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """8-bit mono WAV bytes of a payload."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    """The 8-bit samples of WAV bytes."""
    with wave.open(io.BytesIO(media), "rb") as r:
        if r.getsampwidth() != 1 or r.getnchannels() != 1:
            raise ValueError("8-bit mono samples are expected")
        return r.readframes(r.getnframes())


def padded(text: bytes, frame: int = FRAME) -> bytes:
    """text and bytes 255 up to a positive multiple of frame."""
    n = max(1, -(-len(text) // frame)) * frame
    return text + b"\xff" * (n - len(text))


def peaks(samples: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The PEAKS strongest local maxima of each window, as bins, strongest first; -1 where there are fewer."""
    out = np.full((len(starts), PEAKS), -1, np.int64)
    for at in range(0, len(starts), 1024):
        rows = samples[starts[at : at + 1024, None] + np.arange(FRAME)] - 128.0
        mag = np.floor(np.abs(np.fft.rfft(rows * _WINDOW, axis=1)) * 4 + 0.3719).astype(np.int64)
        inner = mag[:, 1:-1]
        top = (inner > mag[:, :-2]) & (inner >= mag[:, 2:]) & (inner > 64)
        # a key of magnitude and then lower bin makes every choice unique
        key = np.where(top, inner * FRAME + (FRAME - 1 - np.arange(1, mag.shape[1] - 1)), 0)
        best = np.sort(np.partition(key, -PEAKS, axis=1)[:, -PEAKS:], axis=1)[:, ::-1]
        out[at : at + 1024] = np.where(best > 0, FRAME - 1 - best % FRAME, -1)
    return out


def fingerprints(samples: np.ndarray, frames_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, first code of each row, windows of each row) of samples whose row i has frames_of[i] frames."""
    first = np.concatenate([[0], np.cumsum(frames_of * FRAME)])
    windows = frames_of * (FRAME // HOP) - 1
    row = np.repeat(np.arange(len(windows)), windows)
    base = np.concatenate([[0], np.cumsum(windows)])
    time = np.arange(base[-1]) - base[row]
    bins = peaks(samples, first[row] + time * HOP)
    codes, where = [], []
    for step in range(1, REACH + 1):
        if len(row) <= step:
            break
        same = np.flatnonzero(row[:-step] == row[step:])
        for a in range(PEAKS):
            for b in range(PEAKS):
                p, q = bins[same, a], bins[same + step, b]
                ok = (p >= 0) & (q >= 0)
                codes.append((time[same] << 24 | p << 13 | q << 2 | (step - 1))[ok])
                where.append(row[same][ok])
    codes = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    where = np.concatenate(where) if where else np.zeros(0, np.int64)
    order = np.lexsort((codes, where))
    return codes[order], np.searchsorted(where[order], np.arange(len(windows) + 1)), windows


SCHEMA = (
    "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
    "media_sha256 string, n_windows long, fingerprint array<long>, media binary"
)


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_media: bool = True) -> DataFrame:
    """id, the stored WAV (or null, if keep_media is false) and what was read back from it."""
    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    key = src.schema[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in blocks(offsets):
                facts, read = [], []
                for i in range(a, b):
                    text = data[offsets[i] : offsets[i + 1]].tobytes()
                    media = to_wav(padded(text))
                    payload = from_wav(media)
                    read.append(payload)
                    facts.append((len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-TAIL:]), len(media), hashlib.sha256(media).hexdigest(), media if keep_media else None))
                samples = np.frombuffer(b"".join(read), np.uint8)
                codes, first, windows = fingerprints(samples, np.array([len(x) // FRAME for x in read]))
                cols = list(zip(*facts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        *(pa.array(c, t) for c, t in zip(cols[:6], (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)),
                        pa.array(windows, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(codes, pa.int64())),
                        pa.array(cols[6], pa.binary()),
                    ],
                    names=[key.name, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "n_windows", "fingerprint", "media"],
                )

    return src.mapInArrow(run, f"`{key.name}` {key.dataType.simpleString()}, {SCHEMA}")
