"""Column expressions and column-name rules; everything here stays inside the JVM."""
