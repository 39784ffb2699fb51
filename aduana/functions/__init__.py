"""Expression building blocks: everything is a built-in function, so it stays in generated code."""
