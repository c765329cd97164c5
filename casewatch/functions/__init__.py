"""Column expressions. Built-in functions only, safe with ANSI mode on."""
