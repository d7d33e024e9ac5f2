"""The bytes of a token file, held to a plain version, and what the planes cost."""

import numpy as np
import zstandard

from fairspark.llm import token_files


def plain(ids: np.ndarray) -> bytes:
    bits = int(ids.max()).bit_length()
    out, cur = [np.array([len(ids), bits], "<i8").tobytes()], ids.tolist()
    for k in range(bits - 1, -1, -1):
        plane = [x >> k & 1 for x in cur]
        parts = [plane[i:i + token_files.BLOCK_BITS] for i in range(0, len(plane), token_files.BLOCK_BITS)]
        blocks = [zstandard.ZstdCompressor(level=1).compress(np.packbits(p, bitorder="little").tobytes()) for p in parts]
        out += [np.cumsum([0, *map(sum, parts)]).astype("<i8").tobytes(), np.array([len(x) for x in blocks], "<i8").tobytes(), *blocks]
        cur = [x for x in cur if not x >> k & 1] + [x for x in cur if x >> k & 1]
    return b"".join(out)


def test_bytes_and_back():
    rng = np.random.default_rng(5)
    for top, n in ((49_000, 70_001), (200_000, 65_536), (2, 9)):
        ids = np.append(rng.integers(0, top, n - 1), top).astype(np.uint32)
        data = token_files.encode_matrix(ids)
        assert data == plain(ids)
        assert (token_files.WaveletMatrix(data).decode() == ids).all()
