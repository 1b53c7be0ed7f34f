"""Hashed features of texts and sums over them, shared by the trained scorers."""

from __future__ import annotations

import numpy as np

from ledgerlake.llm import tokens


def hashed(found: tokens.Words, templates: tuple[tuple[int, ...], ...], bits: int,
           beginnings: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Places of all features, text by text within each template, and the text that each belongs to. A template lists
    the distances of its words from the first: (0,) are words, (0, 1) pairs, (0, 2) pairs around a gap.
    ``beginnings`` are lengths of word beginnings, which inflected and compound words share."""
    texts = np.repeat(np.arange(len(found.lengths)), found.lengths)
    places, owners = [], []
    for template in templates:
        values = tokens.gram(found.hashes, template)
        owner = texts[:len(values)]
        whole = owner == texts[max(template):] if max(template) else np.ones(len(values), bool)
        places.append((values[whole] >> np.uint64(64 - bits)).astype(np.int64))
        owners.append(owner[whole])
    for size in beginnings:
        places.append((tokens.beginnings(found, size) >> np.uint64(64 - bits)).astype(np.int64))
        owners.append(texts)
    return np.concatenate(places), np.concatenate(owners)


def distinct(places: np.ndarray, owners: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each feature once per text, in the order of texts."""
    keys = np.unique((owners << bits) | places)
    return keys & ((1 << bits) - 1), keys >> bits


def sums(values: np.ndarray, owners: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(owners, values, count)


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -35, 35)))
