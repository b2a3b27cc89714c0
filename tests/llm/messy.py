"""Constants that brute-force versions share."""

SPACE = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return (text or "").encode().split()
