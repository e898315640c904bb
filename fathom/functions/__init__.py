"""Column rules: functions from Column to Column."""
