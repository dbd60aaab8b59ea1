"""Text tokens and the default stop words."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A token is a run of two or more letters, digits or underscores of any script.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Fixed list: frequent English function words of two or more letters.  Callers may pass their own.
STOP_WORDS = tuple("""
about above after again against all also although always am among an and another any are around as
at be became because become been before behind being below between both but by can cannot could
did do does done down due during each either else even ever every everyone everything few first for
from full further get give go had has have he hence her here hers herself him himself his how
however if in indeed into is it its itself last least less made many may me might mine more most
much must my myself neither never no nobody none nor not nothing now of off often on once one only
onto or other others otherwise our ours ourselves out over own per perhaps please rather same she
should since so some such than that the their them then there therefore these they this those
though through thus to together too two under until up upon us very was we well were what when
where whether which while who whom whose why will with within without would yet you your yours
""".split())


def tokens(text: Column) -> Column:
    """Lower-case tokens of the whole text."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
