from tractscope.plans.refresh import main

if __name__ == "__main__":
    main()
