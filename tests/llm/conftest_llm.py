"""Invented prose for the tests."""


def word(i: int) -> str:
    return "".join("bcdfghjklm"[int(d)] + "aeiou"[int(d) % 5] for d in str(i * 7919 + 11))


def prose(seed: int, n: int) -> str:
    return " ".join(word((seed * 1009 + i * i * 31 + i * seed) % 5000) + ("." if i % 11 == 10 else "") for i in range(n))
