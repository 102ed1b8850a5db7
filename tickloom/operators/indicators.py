"""Technical indicators over bars: moving averages, Bollinger bands, RSI and MACD."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom import fixed_values as fixed
from tickloom.functions.ema import STATE, Macd, running_ema, state_of
from tickloom.operators.series import block_of, block_window, number_rows, with_cells, with_halo

# Rows before a block's first row that any rolling frame can reach.
HALO = max(fixed.SMA_BARS) - 1
# Closes that the newest bar's indicators need.
TAIL = max(fixed.SMA_BARS)
# Blocks of a run, and time cells of a run.
RUN = 256
CELLS_OF_RUN = 1024


def finite_bars(bars: DataFrame) -> DataFrame:
    """A bar whose close is null, NaN or infinite is no part of a series, here and everywhere."""
    return bars.filter(F.coalesce(F.abs(F.col("close")) < float("inf"), F.lit(False)))


def numbered_bars(bars: DataFrame, keys, time, ties, cell_seconds) -> DataFrame:
    """Numbered rows of each series."""
    return number_rows(finite_bars(bars), keys, time, ties, cell_seconds)


def when_enough(rows: int, value: Column) -> Column:
    """Null until the series has ``rows`` bars."""
    return F.when(F.col("_n") >= rows, value)


def stacked(name: str, step: int, times: int, window) -> Column:
    """Sum of ``name`` at this row and at the rows ``step, 2 * step, ...`` before: ``times`` terms."""
    return sum([F.lag(name, step * i).over(window) for i in range(1, times)], F.col(name))


def with_sums(df: DataFrame, window) -> DataFrame:
    """Sums of the last 20, 50 and 200 closes as ``_sum20``, ``_sum50`` and ``_sum200``.

    A frame of 200 rows would be added up anew for every row. Sums of ten closes are, and
    the longer ones are stacked from those: nine look-ups instead of 270 additions. They
    are null where the series is too short.
    """
    tens = df.withColumn("_sum10", F.sum("close").over(window.rowsBetween(-9, 0)))
    fifties = tens.withColumns({"_sum20": stacked("_sum10", 10, 2, window), "_sum50": stacked("_sum10", 10, 5, window)})
    return fifties.withColumn("_sum200", stacked("_sum50", 50, 4, window)).drop("_sum10")


def with_sma(df: DataFrame) -> DataFrame:
    """Moving averages, from ``with_sums``."""
    return df.withColumns({f"sma{n}": when_enough(n, F.col(f"_sum{n}") / n) for n in fixed.SMA_BARS})


def with_bollinger(df: DataFrame, window) -> DataFrame:
    """Bands around the moving average, from ``with_sums``."""
    n = fixed.BOLLINGER_BARS
    measured = df.withColumn("_deviation", F.stddev_pop("close").over(window.rowsBetween(1 - n, 0)))
    middle, spread = F.col(f"_sum{n}") / n, fixed.BOLLINGER_WIDTH * F.col("_deviation")
    bands = {"bb_mid": middle, "bb_upper": middle + spread, "bb_lower": middle - spread}
    return measured.withColumns({name: when_enough(n, band) for name, band in bands.items()}).drop("_deviation")


def with_gain_loss(df: DataFrame, window) -> DataFrame:
    """``prev_close``, ``gain`` and ``loss``; the oldest bar and unchanged closes count 0.0."""
    change = F.col("close") - F.col("prev_close")
    return df.withColumn("prev_close", F.lag("close", 1).over(window)).withColumns(
        {
            "gain": F.when(change > 0, change).otherwise(F.lit(0.0)),
            "loss": F.when(change < 0, -change).otherwise(F.lit(0.0)),
        }
    )


def rsi(gain: Column, loss: Column) -> Column:
    """Simple-average RSI; a series without losses, flat ones included, is 100."""
    return F.when(loss == 0, F.lit(100.0)).otherwise(100.0 - 100.0 / (1.0 + gain / loss))


def with_rsi(df: DataFrame, window) -> DataFrame:
    frame = window.rowsBetween(1 - fixed.RSI_BARS, 0)
    averaged = with_gain_loss(df, window).withColumns(
        {"_gains": F.avg("gain").over(frame), "_losses": F.avg("loss").over(frame)}
    )
    value = rsi(F.col("_gains"), F.col("_losses"))
    return averaged.withColumn("rsi14", when_enough(fixed.RSI_BARS, value)).drop("_gains", "_losses")


def with_rolling(df: DataFrame, window) -> DataFrame:
    """All indicators with a bounded look-back, on rows carrying ``_n``."""
    averaged = with_bollinger(with_sma(with_sums(df, window)), window)
    return with_rsi(averaged.drop(*[f"_sum{n}" for n in fixed.SMA_BARS]), window)


def guarded_macd(fast: Column, slow: Column, signal: Column, rows: Column) -> dict[str, Column]:
    enough = rows >= fixed.MACD_MIN_BARS
    lines = {"macd": fast - slow, "macd_signal": signal, "macd_hist": (fast - slow) - signal}
    return {name: F.when(enough, line) for name, line in lines.items()}


def _scanned(members: Column, start: Column, at: str, macd: Macd) -> Column:
    """The state on entry to each of the sorted ``members``, structs of ``at``, ``rows`` and ``added``."""
    none = F.array().cast(f"array<struct<{at}: bigint, entry: struct<fast: double, slow: double, signal: double>>>")

    def on(acc: Column, member: Column) -> Column:
        seen = F.struct(member[at].cast("bigint").alias(at), acc["state"].alias("entry"))
        return F.struct(macd.after(acc["state"], member["rows"], member["added"]).alias("state"), F.concat(acc["out"], F.array(seen)).alias("out"))

    return F.aggregate(members, F.struct(start.alias("state"), none.alias("out")), on)["out"]


def macd_entries(numbered: DataFrame, keys: tuple[str, ...], block_rows: int, macd: Macd) -> DataFrame:
    """``keys, _block, _entry``: the exact EMA state before each block of a series.

    A block maps the state before it to the one after it: the old state decays by the block's length, and the block adds
    what it makes of the zero state. Such maps compose to maps of the same kind, so blocks are summed up to runs of ``RUN``
    blocks, the runs of a key are walked through, and the states handed down to the blocks again. Nothing is cut off, and
    no task holds more than a run's blocks or a key's runs (``RUN`` * ``block_rows`` rows each).
    """
    last = F.least((F.col("_block") + 1) * block_rows, F.col("_total"))
    sums = macd.sums(F.col("close"), last - F.col("_n"))
    blocks = numbered.withColumn("_block", block_of(block_rows)).groupBy(*keys, "_block").agg(
        F.count(F.lit(1)).alias("rows"),
        *[total.alias(f"_{name}") for total, name in zip(sums, STATE)],
        F.max(F.when(F.col("_n") == 1, F.col("close"))).alias("_first"),
    )
    blocks = blocks.withColumn("added", state_of(*[F.col(f"_{name}") for name in STATE]))
    members = F.array_sort(F.collect_list(F.struct("_block", "rows", "added")))
    runs = blocks.groupBy(*keys, F.floor(F.col("_block") / RUN).alias("_run")).agg(members.alias("members"), F.sum("rows").alias("rows"), F.max("_first").alias("_first"))
    none = state_of(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    whole = F.aggregate("members", none, lambda state, m: macd.after(state, m["rows"], m["added"]))
    runs = runs.withColumn("added", whole)
    of_key = runs.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_run", "rows", "added"))).alias("runs"), F.max("_first").alias("_first"))
    begin = state_of(F.col("_first"), F.col("_first"), F.lit(0.0))
    entered = of_key.select(*keys, F.explode(_scanned(F.col("runs"), begin, "_run", macd)).alias("r")).select(*keys, "r._run", F.col("r.entry").alias("_at_run"))
    inner = runs.join(entered, [*keys, "_run"]).select(*keys, F.explode(_scanned(F.col("members"), F.col("_at_run"), "_block", macd)).alias("b"))
    return inner.select(*keys, "b._block", F.col("b.entry").alias("_entry"))


def with_macd(df: DataFrame, keys: tuple[str, ...], block_rows: int, macd: Macd) -> DataFrame:
    """The MACD lines of the own rows of each block, which carry the state before it as ``_entry``.

    Inside a block the EMAs are running weighted sums from the zero state, of closes in units of the block's largest, so
    that the growing weights can't overflow whatever the prices.
    """
    window = block_window(keys)
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.col("_own"), F.col("close")).otherwise(F.lit(0.0))
    largest = F.max(F.abs(own)).over(Window.partitionBy(*keys, "_block"))
    sized = df.withColumn("_size", F.when(largest > 0, largest).otherwise(F.lit(1.0)))
    sized = sized.withColumns({"_unit": own / F.col("_size"), "_at": F.col("_n") - 1 - F.col("_block") * block_rows})
    averaged = sized.withColumns(
        {f"_ema{span}": running_ema(F.col("_unit"), span, F.col("_at"), so_far) for span in (macd.fast, macd.slow)}
    )
    fast, slow = F.col(f"_ema{macd.fast}"), F.col(f"_ema{macd.slow}")
    smoothed = averaged.withColumn("_signal", running_ema(fast - slow, macd.signal, F.col("_at"), so_far))
    carried = macd.carried(*[F.col("_entry")[name] for name in STATE], F.col("_at") + 1)
    states = [part * F.col("_size") + before for part, before in zip([fast, slow, F.col("_signal")], carried)]
    summed = smoothed.withColumns(dict(zip(["_fast", "_slow", "_smooth"], states)))
    return summed.withColumns(guarded_macd(F.col("_fast"), F.col("_slow"), F.col("_smooth"), F.col("_n")))


def _visible(df: DataFrame) -> DataFrame:
    return df.select(*[name for name in df.columns if not name.startswith("_")])


def rolling_indicators(
    bars: DataFrame,
    keys: tuple[str, ...] = ("symbol",),
    time: str = "time",
    ties: tuple[str, ...] = ("exchange",),
    cell_seconds: int | None = None,
    block_rows: int = 1024,
) -> DataFrame:
    """Every bar with SMA, Bollinger and RSI columns, ``prev_close``, ``gain``, ``loss`` and ``bar_number``."""
    numbered = numbered_bars(bars, keys, time, ties, cell_seconds)
    blocks = with_halo(numbered, block_rows, HALO)
    rolled = with_rolling(blocks, block_window(keys)).filter("_own")
    return _visible(rolled.withColumn("bar_number", F.col("_n")))


def macd_series(
    bars: DataFrame,
    keys: tuple[str, ...] = ("symbol",),
    time: str = "time",
    ties: tuple[str, ...] = ("exchange",),
    cell_seconds: int | None = None,
    macd: Macd = Macd(),
) -> DataFrame:
    """Every bar with the MACD lines."""
    numbered, rows = numbered_bars(bars, keys, time, ties, cell_seconds), macd.block_rows()
    blocks = with_halo(numbered, rows, 0).join(macd_entries(numbered, keys, rows, macd), [*keys, "_block"])
    return _visible(with_macd(blocks, keys, rows, macd))


def indicators(
    bars: DataFrame,
    keys: tuple[str, ...] = ("symbol",),
    time: str = "time",
    ties: tuple[str, ...] = ("exchange",),
    cell_seconds: int | None = None,
    macd: Macd = Macd(),
) -> DataFrame:
    """Every bar with all ten indicator columns.

    ``bars`` should be a stored table: it is scanned once for the row counts and once for
    the rows. ``keys`` names what makes a series; the default interleaves the exchanges of
    a symbol, ``("symbol", "exchange")`` keeps them apart.
    """
    numbered, rows = numbered_bars(bars, keys, time, ties, cell_seconds), macd.block_rows()
    blocks = with_halo(numbered, rows, HALO).join(macd_entries(numbered, keys, rows, macd), [*keys, "_block"])
    full = with_macd(with_rolling(blocks, block_window(keys)), keys, rows, macd).filter("_own")
    return _visible(full).drop("prev_close", "gain", "loss")


def series_summary(
    bars: DataFrame, keys: tuple[str, ...], time: str = "time", ties: tuple[str, ...] = ("exchange",),
    cell_seconds: int | None = None, macd: Macd = Macd(),
) -> DataFrame:
    """One row per key: ``_rows, _oldest, _last, _first`` close, ``_added`` (what the series makes of the zero EMA state),
    ``_tail`` (the last ``TAIL`` closes, oldest first) and ``_newest``, the newest bar.

    Each time cell of a key is folded by the recursion, cells are merged to runs and runs to keys, all by the same
    associative merge; the rows are shuffled once and not numbered.
    """
    celled = with_cells(finite_bars(bars), keys, time, cell_seconds)
    row = F.struct(*[F.col(name) for name in bars.columns])
    closes = F.array_sort(F.collect_list(F.struct(time, *ties, F.col("close").cast("double").alias("close"))))
    cells = celled.groupBy(*keys, "_cell").agg(closes.alias("_closes"), F.max(F.struct(time, *ties, row.alias("bar")))["bar"].alias("newest"))
    zero = state_of(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    cells = cells.select(
        *keys, "_cell", F.size("_closes").cast("bigint").alias("rows"),
        F.col("_closes")[0][time].alias("oldest"), F.element_at("_closes", -1)[time].alias("last"), F.col("_closes")[0]["close"].alias("first"),
        F.aggregate("_closes", zero, lambda state, c: macd.step(state, c["close"])).alias("added"),
        last_of(F.transform("_closes", lambda c: c["close"]), TAIL).alias("tail"), "newest",
    )
    run = F.floor(F.col("_cell") / CELLS_OF_RUN).alias("_run")
    runs = _merged(cells, [*keys, run], "_cell", macd)
    merged = _merged(runs, list(keys), "_run", macd)
    names = ("rows", "oldest", "last", "first", "added", "tail", "newest")
    return merged.select(*keys, *[F.col(name).alias(f"_{name}") for name in names])


def last_of(values: Column, n: int) -> Column:
    return F.slice(values, -F.least(F.lit(n), F.greatest(F.size(values), F.lit(1))), n)


def _merged(parts: DataFrame, by: list, at: str, macd: Macd) -> DataFrame:
    """Consecutive parts of a series as one, in the order of ``at``."""
    names = ("rows", "oldest", "last", "first", "added", "tail", "newest")
    members = F.array_sort(F.collect_list(F.struct(at, *names)))

    def join(one: Column, two: Column) -> Column:
        tail = last_of(F.concat(one["tail"], two["tail"]), TAIL)
        cells = {"rows": one["rows"] + two["rows"], "oldest": one["oldest"], "last": two["last"], "first": one["first"],
                 "added": macd.after(one["added"], two["rows"], two["added"]), "tail": tail, "newest": two["newest"]}
        return F.struct(*[value.alias(name) for name, value in cells.items()])

    plain = lambda member: F.struct(*[member[name].alias(name) for name in names])
    # The newest bar is compared by place alone, so that its columns may be of any type.
    grouped = parts.groupBy(*by).agg(members.alias("_members"))
    rest = F.slice("_members", 2, F.greatest(F.size("_members") - 1, F.lit(0)))
    folded = F.aggregate(rest, plain(F.col("_members")[0]), lambda acc, member: join(acc, member))
    kept = [name for name in grouped.columns if name != "_members"]
    return grouped.select(*kept, folded.alias("_all")).select(*kept, "_all.*")


def state_columns(rows: Column, tail: Column, fast: Column, slow: Column, signal: Column) -> dict[str, Column]:
    """The ten indicators of a series' newest bar from its number of bars, its last closes and its EMAs."""
    mean = lambda values: F.aggregate(values, F.lit(0.0), lambda total, x: total + x) / F.size(values)
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    window = last_of(tail, fixed.BOLLINGER_BARS)
    middle = mean(window)
    deviation = F.sqrt(mean(F.transform(window, lambda x: (x - middle) * (x - middle))))
    recent = last_of(tail, fixed.RSI_BARS + 1)
    changes = F.zip_with(
        F.slice(recent, 2, fixed.RSI_BARS), F.slice(recent, 1, F.size(recent) - 1), lambda now, before: now - before
    )
    gains = total(F.transform(changes, lambda x: F.when(x > 0, x).otherwise(F.lit(0.0))))
    losses = total(F.transform(changes, lambda x: F.when(x < 0, -x).otherwise(F.lit(0.0))))
    band = fixed.BOLLINGER_WIDTH * deviation
    bands = {"bb_mid": middle, "bb_upper": middle + band, "bb_lower": middle - band}
    return {
        **{f"sma{n}": F.when(rows >= n, mean(last_of(tail, n))) for n in fixed.SMA_BARS},
        **{name: F.when(rows >= fixed.BOLLINGER_BARS, value) for name, value in bands.items()},
        "rsi14": F.when(rows >= fixed.RSI_BARS, rsi(gains, losses)),
        **guarded_macd(fast, slow, signal, rows),
    }


def final_state(macd: Macd = Macd()) -> list[Column]:
    """The EMAs after a whole series, from a row of ``series_summary``."""
    begin = state_of(F.col("_first"), F.col("_first"), F.lit(0.0))
    state = macd.after(begin, F.col("_rows"), F.col("_added"))
    return [state[name] for name in STATE]


def latest_indicators(
    bars: DataFrame,
    keys: tuple[str, ...] = ("symbol",),
    time: str = "time",
    ties: tuple[str, ...] = ("exchange",),
    cell_seconds: int | None = None,
    macd: Macd = Macd(),
) -> DataFrame:
    """Each key's newest bar with all ten indicator columns, from ``series_summary``: one pass over the rows."""
    done = series_summary(bars, keys, time, ties, cell_seconds, macd)
    columns = state_columns(F.col("_rows"), F.col("_tail"), *final_state(macd))
    kept = [name for name in bars.columns if name not in columns]
    return done.select(*[F.col("_newest")[name].alias(name) for name in kept], *[value.alias(name) for name, value in columns.items()])


def latest_macd_of(bars: DataFrame, keys=("symbol",), time="time", ties=("exchange",), cell_seconds=None, macd: Macd = Macd()):
    """MACD lines of each key's newest bar."""
    done = series_summary(bars, keys, time, ties, cell_seconds, macd)
    lines = guarded_macd(*final_state(macd), F.col("_rows"))
    return done.select(*keys, *[line.alias(name) for name, line in lines.items()])
