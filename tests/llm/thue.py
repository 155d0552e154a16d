"""Words that polynomial hashes modulo a power of two cannot tell apart."""


def thue_morse(n: int, flip: bool = False) -> str:
    """A word of n letters a and b by the parity of the ones in each place's number, or its mirror."""
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))
