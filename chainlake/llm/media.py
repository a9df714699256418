"""Media columns: texts as 8-bit WAV, and spectral-peak fingerprints of what is read back (operator 1).

The payload becomes the samples of a mono WAV file made and read with the wave module. The
samples read back go through a short-time Fourier transform (Hann window of 192 samples,
hop 96). In each of four bands the strongest bin of a frame is a peak if no neighbouring
frame (two to each side) is stronger there and it is above the frame's mean. A peak is
paired with the next three peaks within 32 frames; each pair gives a code of (bin 1, bin 2,
frames between), stored with its frame: arrays ``fp_time`` and ``fp_code``.

Frames are transformed in blocks of ``block`` frames, so a text of any length needs bounded
memory beyond its samples and its fingerprint.

Edge cases: a null text counts as empty; an empty text is one block of 192 spaces; equal
texts give equal rows; a null id is passed on; an empty table gives an empty table; further
columns are ignored.
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
from pyspark.sql.types import StructType

from .scratch import text_batches
from .text import slices, utf8

UNIT, RATE, WINDOW, HOP = 192, 8000, 192, 96
#: Bins of each band: [low, high).
BANDS = ((1, 12), (12, 28), (28, 56), (56, 97))
_HANN = np.hanning(WINDOW).astype(np.float32)


def payload(text: bytes) -> bytes:
    """The text with spaces appended up to a positive multiple of ``UNIT``."""
    return text.ljust(max(1, -(-len(text) // UNIT)) * UNIT, b" ")


def to_wav(samples: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(1)
        f.setframerate(RATE)
        f.writeframes(samples)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as f:
        if (f.getnchannels(), f.getsampwidth()) != (1, 1):
            raise ValueError("not an 8-bit mono file")
        return f.readframes(f.getnframes())


def strongest(samples: bytes, block: int = 8192) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each frame and band the strongest bin and its magnitude, and each frame's mean magnitude."""
    signal = np.frombuffer(samples, np.uint8).astype(np.float32) - 128
    frames = np.lib.stride_tricks.sliding_window_view(signal, WINDOW)[::HOP]
    bins, tops, means = [], [], []
    for at in range(0, len(frames), block):
        power = np.abs(np.fft.rfft(frames[at : at + block] * _HANN, axis=1))
        means.append(power[:, 1:].mean(1))
        own = [power[:, a:b].argmax(1) + a for a, b in BANDS]
        bins.append(np.stack(own, 1))
        tops.append(np.stack([power[np.arange(len(power)), k] for k in own], 1))
    return np.concatenate(bins), np.concatenate(tops), np.concatenate(means)


def fingerprint(samples: bytes, fan_out: int = 3, reach: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """(frames, codes) of all peak pairs, by frame."""
    bins, tops, means = strongest(samples)
    peak = tops > means[:, None]
    for d in (1, 2):
        peak[d:] &= tops[d:] >= tops[:-d]
        peak[:-d] &= tops[:-d] > tops[d:]
    time, band = np.nonzero(peak)
    tone = bins[time, band]
    times, codes = [], []
    for d in range(1, fan_out + 1):
        apart = time[d:] - time[:-d]
        near = apart <= reach
        times.append(time[:-d][near])
        codes.append((tone[:-d][near] << 16 | tone[d:][near] << 8 | apart[near]))
    time, code = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((code, time))
    return time[order].astype(np.int32), code[order].astype(np.int32)


SCHEMA = (
    "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
    "feature string, fp_time array<int>, fp_code array<int>"
)


def media_columns(docs: DataFrame, id: str = "doc_id", text: str = "text", keep_media: bool = False) -> DataFrame:
    """``id`` and ``SCHEMA``; ``keep_media`` adds the WAV file itself as ``media``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                rows = [_row(x or b"", keep_media) for x in utf8(batch.column(1))]
                columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(_KINDS[: 9 + keep_media])]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    text_batches(docs.sparkSession)
    given = docs.select(id, docs[text].alias("_text"))
    out = StructType(docs.select(id).schema.fields + StructType.fromDDL(SCHEMA + ", media binary" * keep_media).fields)
    names = out.fieldNames()
    return given.mapInArrow(run, out)


_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary())


def _row(text: bytes, keep: bool) -> tuple:
    media = to_wav(payload(text))
    back = from_wav(media)
    time, code = fingerprint(back)
    digest = hashlib.blake2b(time.astype("<i4").tobytes() + code.astype("<i4").tobytes(), digest_size=16).hexdigest()
    row = (len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), f"{len(time)}:{digest}", time, code)
    return row + ((media,) if keep else ())
