import random


def words(rng, n, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


def odd_texts():
    """Texts with copies, near copies, shared passages, blank, empty, null and one very long one."""
    rng = random.Random(7)
    base = [words(rng, rng.randrange(60, 160), 5000) for _ in range(12)]
    passage = words(rng, 90, 5000)
    out = list(base)
    out += [base[0], base[0], base[1].upper(), None, "", " \n\t ", "one two", "one  two", "ONE two three four", "a " * 3000]
    for i in range(4):
        w = base[2].split()
        w[5 + i] = f"edit{i}"
        out.append(" ".join(w))
    out += [f"{base[3]}\n{passage}", f"{passage}\n{base[4]}", f"{passage} {passage}", words(rng, 30_000, 20_000)]
    out += ["é" * 500, "ab" * 700, "x" * 1200, "\n".join([base[5]] * 3)]
    return out
