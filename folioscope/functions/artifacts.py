"""Debris of conversion among keywords: terms of a shape that words do not take."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letter pairs that English words do not hold.
PAIRS = (
    "bq bx bz cj cv cx cz dx fq fv fx fz gq gv gx gz hx hz jb jc jd jf jg jh jk jl jm jn jq jr js jt jv jw jx jz kq kx kz lq lx lz mx mz pq pv px pz "
    "qb qc qd qf qg qh qj qk ql qm qn qp qq qr qs qt qv qw qx qy qz sx tq tx vb vc vd vf vg vh vj vk vl vm vn vp vq vr vs vt vw vx vz wq wv wx wz xj xk xq xr xz yq zj zq zr zx"
).split()
#: Consonants in a row that no word has, and that few have; records in which a term must stand to be real whatever its shape.
HARD_RUN, SOFT_RUN, REAL_FROM = 7, 6, 3
_CONSONANT = "[b-df-hj-np-tv-xz]"
TRIPLE = "|".join(c * 3 for c in "abcdefghijklmnopqrstuvwxyz")


def hard_reason(term: Column) -> Column:
    """Why a lower-case term is no word, or null."""
    letters = F.regexp_replace(term, "[^a-z]", "")
    return (
        F.when(letters == "", "no letters")
        .when(term.rlike("[0-9]"), "letters mixed with digits")
        .when((F.length(letters) >= 4) & ~letters.rlike("[aeiouyw]"), "no vowel")
        .when(term.rlike("q([^u]|$)"), "q without u")
        .when(term.rlike(TRIPLE), "letter three times")
        .when(term.rlike(f"{_CONSONANT}{{{HARD_RUN}}}"), "consonant run")
    )


def soft_reason(term: Column) -> Column:
    """Why a lower-case term is unlikely to be a word, or null."""
    letters = F.regexp_replace(term, "[^a-z]", "")
    long_enough = F.length(letters) >= 4
    pair = F.regexp_extract(letters, f"({'|'.join(PAIRS)})", 1)
    return F.when(long_enough & (pair != ""), F.concat(F.lit("pair "), pair)).when(long_enough & term.rlike(f"{_CONSONANT}{{{SOFT_RUN}}}"), "consonant run")


def verdict(term: Column, df: Column, in_lexicon: Column, named: Column) -> Column:
    """``hard``, ``soft`` or ``kept``. A lexicon, a capital within a sentence or enough records save a soft case only."""
    saved = F.coalesce(in_lexicon, F.lit(False)) | F.coalesce(named, F.lit(False)) | (F.coalesce(df, F.lit(0)) >= REAL_FROM)
    return F.when(hard_reason(term).isNotNull(), "hard").when(soft_reason(term).isNotNull() & ~saved, "soft").otherwise("kept")
