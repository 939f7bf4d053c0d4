"""Pieces of texts that are hard to cut."""

PIECES = ["a", "B", "word ", " The", "'", "'s", "'re", "ll", " ", "  ", "\n", "\n\n", "\t", "é", " é ", "中", "文", "1", "２", "!", "?", ", ", "<|endoftext|>", "<|", "|>", " ", "　", "🙂", "\x1c", "\x85", "É", "ª", "Ⅷ", "²", "_", "-", "​", "क", "ि", "\r\n", "''", "́"]
