"""Plans: raw -> star build order (``star``), layer materialisation (``layers``), the registered
query set (``registry``) and its SQL oracle (``sql_oracle``), concurrent submission (``concurrency``)."""
