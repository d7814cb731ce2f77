"""Texts as sound: lossless 8-bit WAV payloads and spectral-peak fingerprints.

A text's UTF-8 bytes (null: empty), zero-padded to a positive multiple of 64,
become the samples of a mono WAV file; the wave module reads the stored bytes
back.  A short-time Fourier transform (Hann windows of FRAME samples at every half
window from half a window before the first sample, so that all samples weigh the
same) gives magnitudes; the strongest bin of each of `bands` bands of a frame that
stands out of its frame's mean is a peak; each peak is paired with the peaks of the
next `reach` frames' same or neighbouring bands.  A pair is the code time << 24 |
f1 << 16 | f2 << 8 | dt, a time-coded array.  Windows have one length whatever the
size of the payload, so fingerprints of short and long texts can be compared; the
shortest payload has two frames.

Equal texts have equal values, so repeated rows do; an empty table gives none.
Features are computed over blocks of frames: memory does not grow with the text
beyond its own bytes.  Columns that are not kept are not read, and kept ones may
have any name but those returned.
"""

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct_names, free_name, table

UNIT = 64
#: Samples of a window.
FRAME = 256


def payload(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw)), len(raw)


def to_wav(data: bytes, rate: int = 8000) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(data)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def frames_of(samples: np.ndarray, at: int = 0, block: int = 4096) -> np.ndarray:
    """Windowed frames at to at + block (fewer at the end): frame k is centred on sample k * half a frame."""
    hop = FRAME // 2
    n = min(block, -(-len(samples) // hop) + 1 - at)
    first, last = (at - 1) * hop, (at + n) * hop
    part = samples[max(0, first) : last].astype(np.float32) - 128.0
    part = np.pad(part, (max(0, -first), last - max(0, first) - len(part)))
    return np.lib.stride_tricks.sliding_window_view(part, FRAME)[::hop] * np.hanning(FRAME + 1)[:-1].astype(np.float32)


def peaks(samples: np.ndarray, bands: int = 4, block: int = 4096) -> np.ndarray:
    """The peak bin of each band of each frame (frames x bands), -1 where none stands out."""
    frames = -(-len(samples) // (FRAME // 2)) + 1
    edges = np.linspace(1, FRAME // 2 + 1, bands + 1).astype(int)
    out = np.full((frames, bands), -1, dtype=np.int64)
    for at in range(0, frames, block):
        rows = frames_of(samples, at, block)
        n = len(rows)
        power = np.abs(np.fft.rfft(rows, axis=1))
        mean = power[:, 1:].mean(axis=1)
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            top = power[:, a:b].argmax(axis=1)
            high = power[np.arange(n), a + top] > 1.5 * mean
            out[at : at + n, k] = np.where(high, a + top, -1)
    return out


def pairs(found: np.ndarray, reach: int = 3) -> np.ndarray:
    """Time-coded pairs in ascending order."""
    out = []
    for dt in range(1, reach + 1):
        for k in range(found.shape[1]):
            for j in (k - 1, k, k + 1):
                if 0 <= j < found.shape[1] and dt < len(found):
                    a, b = found[:-dt, k], found[dt:, j]
                    t = np.flatnonzero((a >= 0) & (b >= 0))
                    out.append(t << 24 | a[t] << 16 | b[t] << 8 | dt)
    return np.sort(np.concatenate(out)) if out else np.zeros(0, dtype=np.int64)


def _media(batches):
    """First column: the text. Adds n_bytes, media, fingerprint."""
    for b in batches:
        sizes, media, prints = [], [], []
        for t in b.column(0).to_pylist():
            data, n = payload(t)
            stored = to_wav(data)
            sizes.append(n)
            media.append(stored)
            prints.append(pairs(peaks(np.frombuffer(from_wav(stored), dtype=np.uint8))))
        yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(sizes, pa.int64()), pa.array(media, pa.binary()), pa.array(prints, pa.list_(pa.int64()))], names=[*b.schema.names[1:], "n_bytes", "media", "fingerprint"])


def _small(function, rows: int = 256):
    """The function over slices of the batches, so that outputs stay small."""
    def sliced(batches):
        return function(b.slice(i, rows) for b in batches for i in range(0, b.num_rows, rows))

    return sliced


def media_columns(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns keep, n_bytes, media (a WAV file) and fingerprint (time-coded pairs); ValueError if a kept column has one of these names."""
    distinct_names(keep, ("n_bytes", "media", "fingerprint"))
    rows = docs.select(F.col(text).alias(free_name(docs.select(*keep), "_text")), *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(_small(_media), f"{fields}, n_bytes long, media binary, fingerprint array<long>")


DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _digests(batches):
    for b in batches:
        out = []
        for doc, n, media, prints in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n_bytes", "media")), b.column("fingerprint"), strict=True):
            data = from_wav(media)
            codes = prints.values.to_numpy(zero_copy_only=False).astype("<i8")
            out.append((doc, n, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), f"{len(codes)}:{xxhash.xxh64_hexdigest(codes.tobytes())}"))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        columns = zip(*out, strict=True) if out else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.rpartition(" ")[0] for x in DIGESTS.split(", ")])


def op9_wav_fingerprints(spark, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents")).mapInArrow(_small(_digests), DIGESTS)
