"""Arithmetic on sample arrays and levels; decoding and neural models are providers' work."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_db(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 20)


def to_db(level: Column) -> Column:
    return 20 * F.log10(F.greatest(level, F.lit(1e-10)))


def peak(samples: Column) -> Column:
    return F.aggregate(samples, F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x.cast("double"))))


def rms(samples: Column) -> Column:
    return F.sqrt(F.aggregate(samples, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) / F.greatest(F.size(samples), F.lit(1)) + F.lit(1e-12))


def peak_gain(samples: Column, target_db: float) -> Column:
    """dB that bring the peak to the target; 0 for silence."""
    top = peak(samples)
    return F.when(top > 0, F.lit(target_db) - to_db(top)).otherwise(0.0)


def loudness_gain(measured: Column, true_peak_db: Column, target: float, ceiling_db: float) -> Column:
    """dB towards the target loudness that keep the true peak under the ceiling; 0 where loudness can't be measured."""
    bad = measured.isNull() | F.isnan(measured) | (measured <= -1e6)
    return F.when(bad, 0.0).otherwise(F.least(F.lit(target) - measured, F.lit(ceiling_db) - true_peak_db))


def fade_and_pad(samples: Column, fade: int, pad: int) -> Column:
    """Raised-cosine fades of at most half the samples, and pad zeros on both sides."""

    def faded(x: Column) -> Column:
        n = F.least(F.lit(fade), F.floor(F.size(x) / 2).cast("int"))
        ramp = lambda i: 0.5 - 0.5 * F.cos(F.pi() * (i + 0.5) / F.greatest(n, F.lit(1)))
        return F.transform(x, lambda v, i: v.cast("double") * F.when(i < n, ramp(i)).when(i >= F.size(x) - n, ramp(F.size(x) - 1 - i)).otherwise(1.0))

    zeros = F.array_repeat(F.lit(0.0), pad)
    return F.concat(zeros, F.element_at(F.transform(F.array(samples), faded), 1), zeros)


def mono(channels: Column) -> Column:
    """Mean over channels, an array of equally long arrays."""
    n = F.size(channels)
    return F.transform(F.element_at(channels, 1), lambda _, i: F.aggregate(channels, F.lit(0.0), lambda s, c: s + F.element_at(c, i + 1)) / n)


def byte_codes(values: Column) -> Column:
    """Values in [0, 1] as bytes, base64."""
    code = lambda v: F.lpad(F.hex(F.rint(F.least(F.lit(1.0), F.greatest(F.lit(0.0), v.cast("double"))) * 255).cast("int")), 2, "0")
    return F.base64(F.unhex(F.array_join(F.transform(values, code), "")))


def quietest_cut(energies: Column, first: int, last: int) -> Column:
    """Place of the least energy in [first, last), the first of equals; null where there is none."""
    part = F.transform(energies, lambda e, i: F.struct(e.alias("e"), i.alias("i")))
    return F.array_min(F.filter(part, lambda x: (x["i"] >= first) & (x["i"] < last)))["i"]


def unmask_schedule(cells: Column, steps: int, shift: float = 0.1) -> Column:
    """How many cells each step settles, by a shifted time grid: counts that sum to cells."""
    t = lambda i: shift * (i / F.lit(float(steps))) / (1 + (shift - 1) * (i / F.lit(float(steps))))
    reached = lambda i: F.when(i == steps, cells).otherwise(F.ceil(cells * t(i))).cast("long")
    return F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda i: F.least(cells, reached(i)) - F.least(cells, reached(i - 1)))


def normalise_peak(samples: Column, target_db: float) -> Column:
    """struct<samples, gain_db>: samples with their peak at the target; silence is unchanged, with a gain of 0."""
    gained = F.transform(F.array(peak_gain(samples, target_db)), lambda g: F.struct(F.transform(samples, lambda x: x.cast("double") * F.pow(F.lit(10.0), g / 20)).alias("samples"), g.alias("gain_db")))
    return F.element_at(gained, 1)


def cross_fade(chunks: Column, gap: int) -> Column:
    """Chunks in a row, a third of the gap faded out of each, silent, and faded into the next; one chunk is unchanged."""
    n = gap // 3
    ramp = lambda i, size: F.when(size == 1, 0.0).otherwise(i / (size - 1))

    def step(acc: Column, chunk: Column) -> Column:
        out, into = F.least(F.lit(n), F.size(acc)), F.least(F.lit(n), F.size(chunk))
        left = F.transform(acc, lambda x, i: F.when(i >= F.size(acc) - out, x * F.when(out == 1, 1.0).otherwise(1 - ramp(i - (F.size(acc) - out), out))).otherwise(x))
        right = F.transform(chunk, lambda x, i: F.when(i < into, x * F.when(into == 1, 1.0).otherwise(ramp(i, into))).otherwise(x))
        return F.concat(left, F.array_repeat(F.lit(0.0), n), right)

    doubles = F.transform(chunks, lambda c: F.transform(c, lambda x: x.cast("double")))
    return F.aggregate(F.slice(doubles, 2, F.greatest(F.lit(0), F.size(doubles) - 1)), F.element_at(doubles, 1), step)


_RANGES = "array<struct<start: bigint, end: bigint>>"


def silent_ranges(samples: Column, least: int, level: float, step: int) -> Column:
    """Ranges of samples where windows of `least` samples, every `step` and at the end, have an rms of at most level."""
    squares = lambda i: F.aggregate(F.slice(samples, i.cast("int") + 1, least), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    last = (F.size(samples) - least).cast("bigint")
    starts = F.array_distinct(F.array_append(F.sequence(F.lit(0).cast("bigint"), F.greatest(last, F.lit(0).cast("bigint")), F.lit(step).cast("bigint")), last))
    quiet = F.filter(starts, lambda i: F.sqrt(squares(i) / least) <= level)

    def fold(acc: Column, i: Column) -> Column:
        before = F.element_at(acc, -1)
        apart = (i != before["end"] - least + step) & (i > before["end"])
        own = F.struct(i.alias("start"), (i + least).alias("end"))
        longer = F.struct(before["start"].alias("start"), (i + least).alias("end"))
        return F.when(F.size(acc) == 0, F.array(own)).when(apart, F.array_append(acc, own)).otherwise(F.array_append(F.slice(acc, 1, F.size(acc) - 1), longer))

    none = F.expr(f"cast(array() as {_RANGES})")
    return F.when(F.size(samples) < least, none).otherwise(F.aggregate(quiet, none, fold))


def sound_ranges(samples: Column, silent: Column) -> Column:
    """What lies between silent ranges; all samples where there are none, nothing where all is silent."""
    n = F.size(samples).cast("bigint")
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(silent, lambda r: r["end"]))
    ends = F.concat(F.transform(silent, lambda r: r["start"]), F.array(n))
    return F.filter(F.transform(F.arrays_zip(starts.alias("start"), ends.alias("end")), lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))), lambda r: r["start"] < r["end"])


def kept_ranges(sound: Column, n: Column, margin: int) -> Column:
    """Sound with up to a margin of silence on both sides; where margins of two meet, each goes to the middle."""
    wide = F.transform(sound, lambda r: F.struct((r["start"] - margin).alias("a"), (r["end"] + margin).alias("b")))

    def bounds(w: Column) -> Column:
        def own(r: Column, i: Column) -> Column:
            before, after = F.get(w, i - 1), F.get(w, i + 1)
            a = F.when(before.isNotNull() & (r["a"] < before["b"]), F.floor((before["b"] + r["a"]) / 2)).otherwise(r["a"])
            b = F.when(after.isNotNull() & (after["a"] < r["b"]), F.floor((r["b"] + after["a"]) / 2)).otherwise(r["b"])
            return F.struct(F.greatest(a, F.lit(0)).alias("start"), F.least(b, n).alias("end"))

        return F.transform(w, own)

    return F.element_at(F.transform(F.array(wide), bounds), 1)


def cut_ranges(samples: Column, ranges: Column) -> Column:
    """The samples of the ranges, one after the other."""
    return F.flatten(F.transform(ranges, lambda r: F.slice(samples, (r["start"] + 1).cast("int"), (r["end"] - r["start"]).cast("int"))))


def leading_silence(samples: Column, level: float, chunk: int) -> Column:
    """Samples before the first chunk that is louder than level."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(samples) - 1, F.lit(0)), F.lit(chunk))
    loud = F.filter(starts, lambda i: rms_of(F.slice(samples, i + 1, chunk)) >= level)
    return F.least(F.coalesce(F.get(loud, F.lit(0)), F.size(samples)), F.size(samples))


def rms_of(samples: Column) -> Column:
    """Root mean square; 0 of nothing."""
    return F.sqrt(F.aggregate(samples, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) / F.greatest(F.size(samples), F.lit(1)))


def clip_plan(start: Column, end: Column, rate: int, out_rate: int, measured: Column, true_peak_db: Column, target: float, ceiling_db: float, fade: float, pad: float) -> Column:
    """struct of what an export does: samples to read and where, samples written, gain, and samples faded and padded on each side."""
    read = F.floor((end - start) * rate)
    kept = F.ceil(read * out_rate / rate)
    return F.struct(
        F.floor(start * rate).alias("offset"), read.alias("read"), (kept + 2 * int(pad * out_rate)).alias("written"), loudness_gain(measured, true_peak_db, target, ceiling_db).alias("gain_db"),
        F.least(F.lit(int(fade * out_rate)).cast("bigint"), F.floor(kept / 2)).alias("fade"), F.lit(int(pad * out_rate)).cast("bigint").alias("pad"),
    )


def mono_at(channels: Column, rate: Column, wanted: int) -> Column:
    """Mean over channels; an error at run time for another sample rate."""
    wrong = F.raise_error(F.concat(F.lit(f"expected {wanted} samples a second, not "), rate.cast("string"))).cast("array<double>")
    return F.when(rate == wanted, mono(channels)).otherwise(wrong)
