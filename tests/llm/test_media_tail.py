"""The end of a payload counts."""

import numpy as np
import pytest

from riverglass.llm import media_columns


@pytest.mark.parametrize("size", [320, 448, 2624])
def test_last_samples_are_in_a_frame(size):
    samples = np.full(size, 128, np.uint8)
    assert not len(media_columns.peaks(samples.tobytes())[0])
    samples[-64:] = 128 + 100 * np.sin(2 * np.pi * np.arange(64) * 40 / 256)
    frames, _ = media_columns.peaks(samples.tobytes())
    assert len(frames) and frames.max() * media_columns.HOP + media_columns.WINDOW >= size
