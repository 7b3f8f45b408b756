"""Independent versions of operators, for comparison."""

import hashlib

from kinloom.llm.decontaminate import words_of


def contaminated(texts, items, window: int = 10) -> list[tuple]:
    """Every position against every window."""
    out = []
    for doc, text in texts:
        w = words_of((text or "").encode())
        hit, ids = set(), set()
        for item, body in items:
            v = words_of((body or "").encode())
            size = min(window, len(v))
            for i in range(len(v) - size + 1) if v else ():
                for j in range(len(w) - size + 1):
                    if w[j : j + size] == v[i : i + size]:
                        hit.update(range(j, j + size))
                        ids.add(str(item))
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


M64 = (1 << 64) - 1
P1, P2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def order_minhash(text: bytes, factors, offsets, k: int = 8, pick: int = 2) -> str:
    """The printed fingerprint, k-mer by k-mer in plain integers."""
    if not text:
        return "00000000" * len(factors)
    seen: dict[bytes, int] = {}
    numbered = []
    for place in range(max(len(text) - k + 1, 1)):
        gram = text[place : place + k].ljust(k, b"\0")
        h = int.from_bytes(gram, "little")
        h = ((h ^ (h >> 31)) * P1) & M64
        h = ((h ^ (h >> 29)) * P2) & M64
        number = seen.get(gram, 0)
        seen[gram] = number + 1
        x = ((h + number * P2) * P1) & M64
        x = ((x ^ (x >> 32)) * P2) & M64
        numbered.append((x >> 32, place))
    out = ""
    for a, b in zip(factors, offsets, strict=True):
        two = sorted(((x * a + b) & 0xFFFFFFFF, x, place) for x, place in numbered)[:pick]
        tuple_ = [x for _, x, _ in sorted(two, key=lambda r: r[2])] if len(numbered) >= pick else [two[0][1], 0]
        t = ((tuple_[0] * P1 + tuple_[1]) * P2) & M64
        t = ((t ^ (t >> 29)) * P1) & M64
        out += f"{t >> 32:08x}"
    return out


def mixture(model, text: bytes, penalty: float = 3.0, rounds: int = 12):
    """Expectation-maximisation gram by gram; the set by penalised likelihood."""
    import math

    from kinloom.llm.language_id import grams

    tally: dict[int, int] = {}
    for g in grams(text).tolist():
        tally[g] = tally.get(g, 0) + 1
    n = sum(tally.values())
    p = {g: [float(v) for v in model.p[g]] for g in tally}

    def em(which):
        theta = [1 / len(which)] * len(which)
        for _ in range(rounds):
            new = [0.0] * len(which)
            for g, count in tally.items():
                total = sum(t * p[g][k] for t, k in zip(theta, which, strict=True))
                for i, k in enumerate(which):
                    new[i] += count * theta[i] * p[g][k] / total
            theta = [v / n for v in new]
        return theta, sum(count * math.log(sum(t * p[g][k] for t, k in zip(theta, which, strict=True))) for g, count in tally.items())

    alone = [sum(c * math.log(p[g][k]) for g, c in tally.items()) for k in range(len(model.languages))]
    theta, _ = em(range(len(model.languages)))
    order = sorted(range(len(theta)), key=lambda k: (-theta[k], -alone[k]))
    best = max(range(len(alone)), key=alone.__getitem__)
    answer, value = [(model.languages[best], 1.0)], alone[best] - penalty * math.log(n) / 2
    for size in range(2, len(order) + 1):
        if theta[order[size - 1]] * n < 1:
            break
        shares, ll = em(order[:size])
        v = ll - penalty * size * math.log(n) / 2
        if v <= value:
            break
        answer, value = sorted(((model.languages[k], s) for k, s in zip(order, shares, strict=False)), key=lambda x: (-x[1], x[0])), v
    return answer
