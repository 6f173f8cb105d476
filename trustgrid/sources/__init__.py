"""Sources and sinks: table registration, CSV / JSON landing, fixture views."""
