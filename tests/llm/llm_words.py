"""Words of a small made-up language, the same for the same seed."""


def words(n, seed, vocabulary=400):
    out, state = [], seed * 7919 + 13
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2147483648
        out.append("w" + "abcdefghij"[state // 7 % 10] + str(state // 65536 % vocabulary))
    return out
