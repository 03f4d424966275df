"""Security-event analytics for Windows and Active Directory logs, as Spark DataFrame operators."""
