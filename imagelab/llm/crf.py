"""A linear-chain conditional random field with two tags, in numpy.

Tag 0 is neutral and tag 1 offending. A token's score is the log potential of tag 1 over tag 0, a
transition matrix holds the log potentials of neighbouring tags, and a sequence starts as after a
neutral token. Sequences of any length are cut into chunks of fixed width; chunk products are
computed for all chunks at once, chained along each sequence, and then used as the exact start and
end states of a forward and a backward pass inside the chunks.
"""

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

WIDTH = 256
PREFIXES = range(3, 9)


def features_of(word: str) -> list[str]:
    """Features of a lower-case word: itself and its beginnings."""
    return [f"={word}", *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


@dataclass
class Model:
    bias: float = -8.0
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features_of(word))


def marginals(
    scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, with_counts: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """(probability of tag 1 by token, expected transition counts if asked for).

    `scores` holds all sequences one after another, `lengths` their sizes, none of them 0. States
    are kept as ratios of tag 1 to tag 0.
    """
    chunks = -(-lengths // WIDTH)
    first_chunk = np.cumsum(chunks) - chunks
    total = int(chunks.sum())
    if not total:
        return np.zeros(0), np.zeros((2, 2))
    begins = np.cumsum(lengths) - lengths
    at = np.arange(len(scores)) + np.repeat(first_chunk * WIDTH - begins, lengths)
    row, column = at % WIDTH, at // WIDTH
    size = np.bincount(column, minlength=total)  # tokens of each chunk; only a sequence's last one is short
    potential = np.ones((WIDTH, total))
    potential[row, column] = np.exp(np.clip(scores, -30, 30))
    (a00, a01), (a10, a11) = np.exp(transitions)
    starts, ends = np.zeros(total), np.ones(total)
    if chunks.max() > 1:
        _chain(potential, size, chunks, first_chunk, np.exp(transitions), starts, ends)
    forward = np.empty((WIDTH, total))
    state = starts
    for t in range(WIDTH):
        state = forward[t] = potential[t] * (a01 + state * a11) / (a00 + state * a10)
    tagged = np.empty((WIDTH, total))
    counts = np.zeros((2, 2))
    state = ends
    for t in range(WIDTH - 1, -1, -1):
        joint = forward[t] * state
        tagged[t] = joint / (1 + joint)
        later = state * potential[t]
        here = t < size
        if with_counts:
            before = (forward[t - 1] if t else starts)[here]
            arrive = later[here]
            pairs = np.array([[np.full_like(arrive, a00), a01 * arrive], [a10 * before, a11 * before * arrive]])
            counts += (pairs / pairs.sum(axis=(0, 1))).sum(axis=2)
        # padding lies behind the last token, so the state stays as it is there
        state = np.where(here, (a10 + a11 * later) / (a00 + a01 * later), state)
    return tagged[row, column], counts


def _chain(potential, size, chunks, first_chunk, a, starts, ends) -> None:
    """Fill in the states at the starts and ends of the chunks of sequences that have several."""
    many = np.flatnonzero(np.repeat(chunks > 1, chunks))
    rows = np.zeros((2, 2, len(many)))  # image of each tag under the chunk's matrix product
    rows[0, 0] = rows[1, 1] = 1
    scale = np.zeros((2, len(many)))
    for t in range(WIDTH):
        neutral = rows[:, 0] * a[0, 0] + rows[:, 1] * a[1, 0]
        offending = (rows[:, 0] * a[0, 1] + rows[:, 1] * a[1, 1]) * potential[t, many]
        norm = neutral + offending
        use = t < size[many]
        rows[:, 0], rows[:, 1] = np.where(use, neutral / norm, rows[:, 0]), np.where(use, offending / norm, rows[:, 1])
        scale += np.where(use, np.log(norm), 0)
    product = np.zeros((2, 2, len(size)))
    product[:, :, many] = rows * np.exp(scale - scale.max(axis=0))[:, None]
    for k in range(1, int(chunks.max())):
        at = (first_chunk + k)[chunks > k]
        (p00, p01), (p10, p11) = product[:, :, at - 1]
        ratio = starts[at - 1]
        starts[at] = (p01 + ratio * p11) / (p00 + ratio * p10)
    for k in range(int(chunks.max()) - 2, -1, -1):
        at = (first_chunk + k)[chunks > k + 1]
        (p00, p01), (p10, p11) = product[:, :, at + 1]
        ratio = ends[at + 1]
        ends[at] = (p10 + p11 * ratio) / (p00 + p01 * ratio)


def fit(
    documents: Sequence[Sequence[str]], tags: Sequence[np.ndarray], rounds: int = 40, decay: float = 1e-3, rate: float = 0.3
) -> Model:
    """Maximum conditional likelihood with an L2 penalty, by Adam over the whole sample."""
    documents, tags = zip(*[(d, t) for d, t in zip(documents, tags) if len(d)]) if any(documents) else ((), ())
    if not documents or not sum(int(t.sum()) for t in tags):
        return Model()
    words, inverse = np.unique(np.concatenate([np.array(d, dtype=object) for d in documents]).astype(str), return_inverse=True)
    lengths = np.array([len(d) for d in documents])
    y = np.concatenate(tags).astype(float)
    seen = np.bincount(inverse, minlength=len(words))
    marked = np.bincount(inverse, weights=y, minlength=len(words))
    names: dict[str, int] = {}
    pairs = [(at, names.setdefault(f, len(names))) for at, w in enumerate(words.tolist()) if seen[at] > 1 or marked[at] for f in features_of(w)]
    of_word, of_feature = np.array(pairs).T
    first = np.zeros(len(y), bool)
    first[np.cumsum(lengths) - lengths] = True
    before = np.where(first, 0, np.concatenate(([0], y[:-1]))).astype(int)
    observed = np.zeros((2, 2))
    np.add.at(observed, (before, y.astype(int)), 1)
    theta = np.zeros(len(names) + 5)
    theta[-5] = -5.0
    momentum, square = np.zeros_like(theta), np.zeros_like(theta)
    n = max(1.0, y.sum())
    for k in range(1, rounds + 1):
        transitions = theta[-4:].reshape(2, 2)
        by_word = theta[-5] + np.bincount(of_word, weights=theta[of_feature], minlength=len(words))
        p, expected = marginals(by_word[inverse], lengths, transitions, with_counts=True)
        error = np.bincount(inverse, weights=p - y, minlength=len(words))
        slope = np.concatenate((
            np.bincount(of_feature, weights=error[of_word], minlength=len(names)),
            [(p - y).sum()],
            (expected - observed).ravel(),
        )) / n + decay * theta
        momentum = 0.9 * momentum + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta -= rate * (momentum / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-6)
    kept = {name: float(theta[at]) for name, at in names.items() if abs(theta[at]) > 0.01}
    return Model(float(theta[-5]), theta[-4:].reshape(2, 2).copy(), kept)
