"""Silver: one cleaned row per record.

Every model keeps the same order of steps, because it decides which rows live:
keys and ranges are checked first, then the newest remaining version wins, and
only then are dates judged. An older valid version therefore replaces a newer
invalid one, but a newest version dated in the future takes its record away.

The status columns judge the values before the last correction, so they are
computed next to the corrected columns and never from them.
"""
