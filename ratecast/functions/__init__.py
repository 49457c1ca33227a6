from ratecast.functions.timecols import freq_micros, to_micros, from_micros  # noqa: F401
